"""The whole job on files: read, roll up, write, validate."""

from datetime import datetime

import pytest
from notation import expected_rows, parse, rows_frame, summary_rows
from pyspark.sql import functions as F

from spanfold.plans import job as batch
from spanfold.sources.job import JobParameters
from spanfold.sources.sink import read_summary

ROWS = "HH1 A:4[11,12] B:5[21,22] A:6[31,32] B:-[31,32] HH2 A:1[31,32] B:2[21,22] B:3[11,12] 0 A:1[1,2]"
SUMMARY = "HH1 A:{4}[11,12] B:{5}[21,32] A:{6}[31,32] HH2 A:{1}[31,32] B:{2,3}[11,22]"


@pytest.fixture
def job(spark, tmp_path):
    rows = rows_frame(spark, parse(ROWS))
    for customer in (123, 456):
        for day in ("2020-10-01", "2020-10-31", "2020-11-02"):
            keep = rows if day == "2020-10-01" else rows.where("householdId = 'HH1'")
            shifted = keep if day == "2020-10-01" else keep.withColumn("householdId", F.lit("late"))
            shifted.write.parquet(f"{tmp_path}/in/Daily/customer={customer}/dt={day}")
    return JobParameters(
        (123,), datetime(2020, 10, 1), datetime(2020, 10, 31),
        base_dir=f"{tmp_path}/out/", input_dir=f"{tmp_path}/in/",
    )


def test_run_and_validate(spark, job):
    batch.run(spark, job)
    written = read_summary(spark, job.output_path)
    assert summary_rows(written) == expected_rows(parse(SUMMARY))
    results = batch.validate(spark, job)
    assert results.households.count() == 2 and results.interleaving.count() == 2


def test_rejected_rows_are_kept(spark, job):
    day = f"{job.input_path}/customer=123/dt=2020-10-05"
    bad = rows_frame(spark, parse("HH9 A:4[11,12] B:5[22,21] C:1[1,2]"))
    bad = bad.withColumn("ip", F.when(F.col("ip") == 10, None).otherwise(F.col("ip")))
    bad.write.parquet(day)
    batch.run(spark, job)
    kept = batch.read_rejects(spark, job).collect()
    assert sorted((r.householdId, r.ip, str(r.dt)) for r in kept if r.ip) == [("HH9", 20, "2020-10-05")]
    assert [r.ip for r in kept if r.ip is None] == [None]
    batch.validate(spark, job)
    batch.read_rejects(spark, job).limit(1).write.mode("overwrite").parquet(job.rejects_path + "x")
    spark.read.parquet(job.rejects_path + "x").write.mode("overwrite").parquet(job.rejects_path)
    with pytest.raises(AssertionError, match="rejected rows: expected 2, found 1"):
        batch.validate(spark, job)


def test_a_summary_of_other_rows_does_not_validate(spark, job):
    batch.run(spark, job)
    longer = JobParameters(
        (123,), job.date_from, datetime(2020, 11, 1), base_dir=job.base_dir, input_dir=job.input_dir,
    )
    batch.run(spark, longer)
    read_summary(spark, longer.output_path).write.mode("overwrite").partitionBy("version").parquet(
        job.output_path
    )
    with pytest.raises(AssertionError, match="nHHs: expected 2, found 3"):
        batch.validate(spark, job)
