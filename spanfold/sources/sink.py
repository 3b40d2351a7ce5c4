"""Writing and re-reading household summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanfold.sources import manifest as published
from spanfold.sources.rows import CLIENT_ID, TIME_SPAN

MAX_RECORDS_PER_FILE = 2_350_000

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("householdId", T.StringType()),
        T.StructField("ip", T.IntegerType()),
        T.StructField("timeSpan", TIME_SPAN),
        T.StructField("clientIds", T.ArrayType(CLIENT_ID)),
        T.StructField("version", T.StringType()),
    ]
)


def write_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One directory per version. The version is one constant, so the rows are not
    repartitioned by it, which would leave the write to one task: a rebalance
    evens out file sizes and splits what is too large."""
    (
        summary.hint("rebalance")
        .write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .mode(mode)
        .partitionBy("version")
        .parquet(path)
    )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """What the current manifest of the folder names as ``summary``; without a manifest, all
    that is there."""
    found = published.current(spark, path)
    if found is None:
        return spark.read.schema(SUMMARY_SCHEMA).parquet(path).select(*SUMMARY_SCHEMA.fieldNames())
    return published.read(spark, path, found.parts["summary"], SUMMARY_SCHEMA)
