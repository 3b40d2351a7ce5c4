"""The batch job: read a window of rows, roll it up, publish it with what could not be rolled
up; then check both.

The source is read once. What was read is split into usable rows and rejects by one write to
the scratch folder, counted as it goes by; the search for hot households, the roll-up and the
rejects start from there. So all of them saw the same rows, even if files arrive meanwhile.

Summary and rejects are published together (``sources.manifest``): each is written into a
directory of its own, and the manifest beside the summary names both last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanfold.plans.stats import client_facts, combined_facts
from spanfold.plans.summary import LIMITS, Hot, Limits, household_summary
from spanfold.plans.validation import (
    ValidationRun,
    raise_failed,
    rejects_report,
    validation_report,
)
from spanfold.sources import manifest as published
from spanfold.sources.files import Folder
from spanfold.sources.job import JobParameters
from spanfold.sources.manifest import Manifest
from spanfold.sources.rows import LAYOUT_SCHEMA, is_usable, read_window, rejects
from spanfold.sources.scratch import fresh_path, stored
from spanfold.sources.sink import read_summary, write_summary

SAVE_MODES = ("overwrite", "append", "ignore", "error")


@dataclass(frozen=True)
class JobMetrics:
    """Rows that were read, those of them that could be rolled up and those that could not,
    and rows of the summary."""

    read: int
    usable: int
    rejected: int
    written: int


class AlreadyPublished(RuntimeError):
    """Mode ``error`` found output of an earlier run."""


def read(spark: SparkSession, job: JobParameters) -> DataFrame:
    return read_window(
        spark, job.input_path, job.customer_ids, job.date_from, job.date_to, job.grain_from
    )


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Usable rows, rejects, and how many there are of each: one pass, one written table."""
    spark = rows.sparkSession
    path, seen = fresh_path(spark, "split"), Observation("rows read")
    marked = rows.withColumn("usable", is_usable())
    n, usable = F.count(F.lit(1)), F.count_if("usable")
    counted = marked.observe(seen, n.alias("read"), usable.alias("usable"), (n - usable).alias("rejected"))
    counted.write.partitionBy("usable").parquet(path)
    written = spark.read.schema(marked.schema).parquet(path)
    sides = (written.where(side).select(*rows.columns) for side in (F.col("usable"), ~F.col("usable")))
    return *sides, dict(seen.get)


def run(
    spark: SparkSession, job: JobParameters, hot: Limits | Hot = LIMITS, mode: str = "overwrite"
) -> JobMetrics | None:
    """Every row read is in the summary or among the rejects. ``mode`` says what becomes of the
    output of an earlier run: replaced, added to, left (and nothing done), or an error."""
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}: {mode}")
    earlier = published.current(spark, job.output_path)
    if earlier is not None and mode == "error":
        raise AlreadyPublished(job.output_path)
    if earlier is not None and mode == "ignore":
        return None
    after = (earlier or Manifest()).following()
    generation = published.generation(after.version)
    usable, rejected, counts = split(read(spark, job))
    seen = Observation("rows written")
    rolled_up = household_summary(usable, hot).observe(seen, F.count(F.lit(1)).alias("written"))
    write_summary(rolled_up, f"{job.output_path}/{generation}")
    rejected.write.parquet(f"{job.rejects_path}/{generation}")
    metrics = JobMetrics(**counts, written=seen.get["written"])
    for dataset in ("summary", "rejects"):
        before = [] if earlier is None or mode != "append" else earlier.parts[dataset]
        after = after.with_parts(dataset, [*before, generation])
    figures = vars(metrics)
    published.publish(
        spark, job.output_path, Manifest(after.version, after.parts, figures, after.batches)
    )
    return metrics


def metrics(spark: SparkSession, job: JobParameters) -> JobMetrics | None:
    """Those of the last published run."""
    found = published.current(spark, job.output_path)
    return None if found is None else JobMetrics(**found.figures)


def read_rejects(spark: SparkSession, job: JobParameters) -> DataFrame:
    found = published.current(spark, job.output_path)
    parts = [] if found is None else found.parts["rejects"]
    files = Folder(spark, job.rejects_path)
    if parts and all(map(files.exists, parts)):
        return published.read(spark, job.rejects_path, parts, LAYOUT_SCHEMA)
    return spark.read.schema(LAYOUT_SCHEMA).parquet(job.rejects_path)  # not written by a job


def validate(spark: SparkSession, job: JobParameters) -> ValidationRun:
    """Check what was written against its input; the results of the run when every check
    holds. Both read one aggregation of the input."""
    rows, summary = read(spark, job), read_summary(spark, job.output_path)
    facts = stored(client_facts(rows, "customer"), "facts")
    report = validation_report(facts, summary).unionByName(
        rejects_report(rejects(rows), read_rejects(spark, job))
    )
    raise_failed(report)
    return ValidationRun.of(rows, summary, combined_facts(facts))
