"""Publishing by manifest: jobs that stop half-way, save modes, metrics, one scan."""

import re
from datetime import datetime

import pytest
from notation import expected_rows, parse, rows_frame, summary_rows
from pyspark.sql import functions as F

from spanfold.plans import job as batch
from spanfold.sources import manifest as published
from spanfold.sources.files import Folder
from spanfold.sources.job import JobParameters
from spanfold.sources.manifest import Manifest, PublishedMeanwhile
from spanfold.sources.sink import read_summary

FIRST = "HH1 A:4[11,12] B:5[21,22] HH2 A:1[31,32]"
SECOND = "HH1 A:4[11,12] B:5[21,22] HH3 C:9[1,2]"


@pytest.fixture
def job(spark, tmp_path):
    found = JobParameters(
        (1,), datetime(2020, 10, 1), datetime(2020, 10, 31),
        base_dir=f"{tmp_path}/out/", input_dir=f"{tmp_path}/in/",
    )
    put(spark, found, FIRST)
    return found


def put(spark, job, rows):
    broken = rows_frame(spark, parse(rows)).union(
        rows_frame(spark, parse("HH8 A:4[12,11]"))
    )
    broken.write.mode("overwrite").parquet(f"{job.input_path}/customer=1/dt=2020-10-02")


def seen(spark, job):
    return summary_rows(read_summary(spark, job.output_path)), batch.read_rejects(spark, job).count()


def wanted(rows):
    return expected_rows(parse(re.sub(r":(\d+)\[", r":{\1}[", rows)))


@pytest.mark.parametrize("stop", ["write_summary", "rejects", "publish"])
def test_a_job_that_stops_leaves_the_last_pair(spark, job, monkeypatch, stop):
    batch.run(spark, job)
    before = seen(spark, job)
    assert before == (wanted(FIRST), 1)
    put(spark, job, SECOND)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if stop == "publish":
            patch.setattr(batch.published, "publish", fail)
        elif stop == "write_summary":
            patch.setattr(batch, "write_summary", fail)
        else:  # the summary is written, the rejects are not
            whole = batch.split

            def halved(rows):
                usable, _, counts = whole(rows)
                return usable, Unwritable(), counts

            patch.setattr(batch, "split", halved)
        with pytest.raises(RuntimeError, match="lost"):
            batch.run(spark, job)
    assert seen(spark, job) == before
    batch.run(spark, job)
    assert seen(spark, job) == (wanted(SECOND), 1)


class Unwritable:
    @property
    def write(self):
        raise RuntimeError("lost")


def test_save_modes(spark, job):
    assert batch.run(spark, job, mode="error") == batch.JobMetrics(4, 3, 1, 3)
    with pytest.raises(batch.AlreadyPublished):
        batch.run(spark, job, mode="error")
    put(spark, job, SECOND)
    assert batch.run(spark, job, mode="ignore") is None
    assert seen(spark, job) == (wanted(FIRST), 1)
    batch.run(spark, job, mode="append")
    assert seen(spark, job) == (sorted(wanted(FIRST) + wanted(SECOND)), 2)
    batch.run(spark, job)
    assert seen(spark, job) == (wanted(SECOND), 1)
    assert batch.metrics(spark, job) == batch.JobMetrics(4, 3, 1, 3)
    with pytest.raises(ValueError):
        batch.run(spark, job, mode="upsert")


def test_the_source_is_scanned_once(spark, job, monkeypatch):
    """The roll-up and the rejects read what one pass has split."""
    read = []
    write = batch.write_summary

    def watched(df, path):
        read.extend(df.inputFiles())
        write(df, path)

    monkeypatch.setattr(batch, "write_summary", watched)
    batch.run(spark, job)
    assert read and all("/split-" in file and "/in/Daily" not in file for file in read)


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    folder = str(tmp_path / "data")
    first = Manifest().following().with_parts("t", ["gen=1"])
    assert published.current(spark, folder) is None
    published.publish(spark, folder, first)
    with pytest.raises(PublishedMeanwhile):
        published.publish(spark, folder, Manifest().following().with_parts("t", ["gen=2"]))
    assert published.current(spark, folder) == first
    assert [n for n in Folder(spark, folder).names(published.VERSIONS) if n.endswith(".json")] == ["000000000001.json"]


def test_old_generations_can_be_removed(spark, job):
    for rows in (FIRST, SECOND, FIRST):
        put(spark, job, rows)
        batch.run(spark, job)
    unfinished = published.generation(99)
    read_summary(spark, job.output_path).write.parquet(f"{job.output_path}/{unfinished}")
    assert len(published.vacuum(spark, job.output_path, [""], keep=1)) == 2
    assert seen(spark, job)[0] == wanted(FIRST)
    left = [n for n in Folder(spark, job.output_path).names() if n.startswith("gen=")]
    assert len(left) == 2 and unfinished in left
    assert published.versions(spark, job.output_path) == [3]


def test_no_rows(spark, job):
    rows_frame(spark, parse("0 A:1[1,2]")).write.mode("overwrite").parquet(f"{job.input_path}/customer=1/dt=2020-10-02")
    assert batch.run(spark, job) == batch.JobMetrics(0, 0, 0, 0)
    assert read_summary(spark, job.output_path).count() == 0 == batch.read_rejects(spark, job).count()


def test_split_keeps_every_row(spark):
    rows = rows_frame(spark, parse(FIRST)).withColumn("timeSpan", F.when(F.col("householdId") == "HH1", F.col("timeSpan")))
    usable, rejected, counts = batch.split(rows)
    assert counts == {"read": 3, "usable": 2, "rejected": 1}
    assert usable.columns == rejected.columns == rows.columns
    assert (usable.count(), rejected.count()) == (2, 1)
