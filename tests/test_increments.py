"""A stored summary under increments against the summary of all rows at once."""

import random

import pytest
from notation import PLAIN, SLICED, parse, rows_frame, summary_rows
from pyspark.sql import functions as F

from spanfold.plans.increments import SummaryStore
from spanfold.plans.summary import household_summary
from spanfold.sources import manifest as published
from spanfold.sources.files import Folder


def random_notation(seed, households=9, rows=80):
    chance = random.Random(seed)
    found = {}
    for _ in range(rows):
        start = chance.randrange(0, 400)
        client = chance.choice(["-", "1", "2", "3"])
        span = f"{chance.choice('ABC')}:{client}[{start},{start + chance.randrange(0, 25)}]"
        found.setdefault(f"HH{chance.randrange(households)}", []).append(span)
    return " ".join(f"{h} {' '.join(spans)}" for h, spans in found.items())


@pytest.mark.parametrize(("seed", "limits"), [(1, PLAIN), (2, PLAIN), (3, SLICED)])
def test_any_order_of_increments(spark, tmp_path, seed, limits):
    rows = rows_frame(spark, parse(random_notation(seed)))
    parts = rows.withColumn("part", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in ("householdId", "timeSpan")]), F.lit(3)))
    store = SummaryStore(spark, str(tmp_path / "store"), n_buckets=4)
    for part in (2, 0, 1):
        store.add(parts.where(F.col("part") == part).drop("part"), limits)
    assert summary_rows(store.summary()) == summary_rows(household_summary(rows, PLAIN))


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    rows = rows_frame(spark, parse(random_notation(3, households=20)))
    path = str(tmp_path / "store")
    store = SummaryStore(spark, path, n_buckets=8)
    store.add(rows, PLAIN)
    before = store.manifest()
    more = rows_frame(spark, parse("HH1 A:7[1000,1001] B:8[2000,2001]"))
    touched = [r[0] for r in more.select(store._bucket()).distinct().collect()]
    assert len(touched) == 1
    others = [p for t in ("islands", "summary") for p in before.parts[t] if not p.endswith(f"bucket={touched[0]}")]
    for table in ("islands", "summary"):  # whoever reads them now fails
        for part in before.parts[table]:
            if part in others:
                Folder(spark, f"{path}/{table}").remove(part)
    after = store.add(more, PLAIN)
    assert after.version == 2
    for table in ("islands", "summary"):
        kept = [p for p in after.parts[table] if p in before.parts[table]]
        assert set(kept) == {p for p in before.parts[table] if p in others}
        assert len(set(after.parts[table]) - set(kept)) == 1
        (generation,) = [n for n in Folder(spark, f"{path}/{table}").names() if n not in {p.split("/")[0] for p in before.parts[table]}]
        assert [n for n in Folder(spark, f"{path}/{table}").names(generation) if n.startswith("bucket=")] == [f"bucket={touched[0]}"]
    there = store._read("summary", after, touched).where("householdId = 'HH1'")
    expected = rows.where("householdId = 'HH1'").unionByName(more)
    assert summary_rows(there) == summary_rows(household_summary(expected, PLAIN))


def test_repeated_and_empty_increments(spark, tmp_path):
    rows = rows_frame(spark, parse(random_notation(5)))
    store = SummaryStore(spark, str(tmp_path / "store"), n_buckets=4)
    assert store.summary().count() == 0
    store.add(rows.limit(0), PLAIN)
    store.add(rows, PLAIN, source="s", batch=7)
    once = summary_rows(store.summary())
    assert store.add(rows, PLAIN, source="s", batch=7).version == 2  # not folded again
    assert store.add(rows, PLAIN, source="s", batch=8).version == 3
    store.add(rows, PLAIN)
    assert summary_rows(store.summary()) == once == summary_rows(household_summary(rows, PLAIN))


def test_an_increment_that_stops_is_not_seen(spark, tmp_path, monkeypatch):
    rows = rows_frame(spark, parse(random_notation(6)))
    store = SummaryStore(spark, str(tmp_path / "store"), n_buckets=4)
    store.add(rows.where("ip = 10"), PLAIN)
    before = summary_rows(store.summary())
    with monkeypatch.context() as patch:
        patch.setattr(published, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.add(rows.where("ip <> 10"), PLAIN)
    assert summary_rows(store.summary()) == before
    store.add(rows.where("ip <> 10"), PLAIN)
    assert summary_rows(store.summary()) == summary_rows(household_summary(rows, PLAIN))
