"""Run stores, catalog tables, and a stream into a stored summary."""

import re
from datetime import datetime

import pytest
from notation import PLAIN, expected_rows, parse, rows_frame, summary_rows

from spanfold.plans import diff
from spanfold.plans.increments import SummaryStore
from spanfold.plans.summary import household_summary
from spanfold.plans.validation import ValidationRun
from spanfold.sources import catalog
from spanfold.sources import manifest as published
from spanfold.sources.files import Folder
from spanfold.sources.rows import ROW_SCHEMA, read_window
from spanfold.sources.runs import RunStore
from spanfold.streaming.store import stream_into

ROWS = "HH1 A:4[11,12] B:5[21,22] A:6[31,32] HH2 A:1[31,32] B:2[21,22]"


def test_stored_runs_are_compared_without_their_rows(spark, tmp_path):
    store, path = RunStore(spark, str(tmp_path / "runs")), str(tmp_path / "rows")
    rows_frame(spark, parse(ROWS)).write.parquet(path)
    rows = spark.read.parquet(path)
    for name, some in (("all", rows), ("some", rows.where("ip = 10"))):
        store.save(name, ValidationRun.of(some, household_summary(some, PLAIN)), rows=some.count())
    Folder(spark, path).remove()  # whoever reads the rows now fails
    assert store.names() == ["all", "some"]
    loaded = store.load("all")
    assert loaded.figures == {"rows": 5} and set(loaded.tables()) >= {"households", "summary"}
    same = diff.compare_exact(loaded, store.load("all")).collect()
    assert same and all(r.nMismatched == 0 for r in same)
    other = {r.table: r.nMismatched for r in diff.compare_exact(loaded, store.load("some")).collect()}
    assert other["households"] > 0 and other["statistics of counts"] > 0


def test_versions_of_a_run(spark, tmp_path, monkeypatch):
    store = RunStore(spark, str(tmp_path / "runs"))
    rows = rows_frame(spark, parse(ROWS))
    run = ValidationRun.of(rows, household_summary(rows, PLAIN))
    store.save("r", run, number=1)
    with monkeypatch.context() as patch:
        patch.setattr(published, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        for name in ("r", "new"):
            with pytest.raises(RuntimeError, match="lost"):
                store.save(name, run, number=2)
    assert store.names() == ["r"] and store.load("r").figures == {"number": 1}
    store.save("r", run, number=3)
    assert store.load("r").figures == {"number": 3} and store.load("r", 1).figures == {"number": 1}
    with pytest.raises(KeyError):
        store.load("new")
    with pytest.raises(ValueError):
        store.save("../x", run)


def test_a_catalog_table_lists_only_what_is_wanted(spark, tmp_path):
    base = str(tmp_path / "Daily")
    for customer in (1, 2, 3):
        for day in ("2020-10-01", "2020-10-02", "2020-11-01"):
            rows_frame(spark, parse(ROWS)).write.parquet(f"{base}/customer={customer}/dt={day}")
    table = "assignments_of_a_test"
    catalog.create(spark, table, base)
    try:
        assert spark.table(table).count() == 0
        known = catalog.partitions_of(spark, base, (1, 2, 3))
        assert len(known) == 9
        catalog.register(spark, table, known)
        catalog.register(spark, table, known[:2])
        window = (1, 2), datetime(2020, 10, 1), datetime(2020, 10, 2, 5)
        found = catalog.read_window(spark, table, *window)
        plain = read_window(spark, base, *window)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() == 20
        # a directory that no window asks for may be gone: it is not listed
        Folder(spark, base).remove("customer=3")
        Folder(spark, base).remove("customer=1/dt=2020-11-01")
        spark.catalog.refreshTable(table)
        found = catalog.read_window(spark, table, *window)
        assert found.count() == 20
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*customer#\d+ IN \(1,2\)", plan)
        assert re.search(r"InMemoryFileIndex\(4 paths\)", plan)
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_a_stream_into_a_summary(spark, tmp_path, monkeypatch):
    """Batches in any order; one that is replayed after a failure counts once."""
    source, store = str(tmp_path / "in"), SummaryStore(spark, str(tmp_path / "store"), n_buckets=4)
    parts = ["HH1 A:6[31,32] HH2 B:2[21,22]", "HH1 A:4[11,12]", "HH1 B:5[21,22] HH2 A:1[31,32]"]

    def arrive(text):
        rows_frame(spark, parse(text)).coalesce(1).write.mode("append").parquet(source)

    def stream():
        rows = spark.readStream.schema(ROW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        return stream_into(rows, store, str(tmp_path / "checkpoint"), "s", PLAIN)

    arrive(parts[0])
    stream().awaitTermination()
    once = store.manifest().version
    # published, but Spark does not learn of it
    arrive(parts[1])
    add = SummaryStore.add

    def lost(self, *args, **options):
        add(self, *args, **options)
        raise RuntimeError("lost after publishing")

    with monkeypatch.context() as patch:
        patch.setattr(SummaryStore, "add", lost)
        with pytest.raises(Exception, match="lost after publishing"):
            stream().awaitTermination()
    assert store.manifest().version == once + 1
    arrive(parts[2])
    stream().awaitTermination()
    assert store.manifest().version == once + 2  # the replayed batch was left out
    rows = rows_frame(spark, parse(ROWS))
    assert summary_rows(store.summary()) == summary_rows(household_summary(rows, PLAIN))
    assert summary_rows(store.summary()) == expected_rows(
        parse("HH1 A:{4}[11,12] B:{5}[21,22] A:{6}[31,32] HH2 B:{2}[21,22] A:{1}[31,32]")
    )
