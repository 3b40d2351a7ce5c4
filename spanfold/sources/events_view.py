"""Assignment rows derived from an ``events`` table.

Columns: the row schema plus ``customer``, ``dt`` and ``eventId``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.functions.spans import time_span, utc_date
from spanfold.sources.rows import SUMMARY_VERSION

# The file keeps ``ts`` without a zone; reading it as an instant takes it as UTC,
# whatever the session time zone.
EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def _view(
    spark: SparkSession, sf_dir: str, household: Column, ip: Column, client: Column
) -> DataFrame:
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    start = F.unix_millis("ts")
    end = start + F.floor(F.col("value") * 600_000)
    no_client = F.array().cast("array<int>")
    return events.select(
        ip.cast("int").alias("ip"),
        F.when(F.col("event_type") == "error", no_client)
        .otherwise(F.array(client.cast("int")))
        .alias("clientId"),
        time_span(start, end).alias("timeSpan"),
        household.cast("string").alias("householdId"),
        F.lit(0).cast("tinyint").alias("status"),
        F.lit(SUMMARY_VERSION).alias("version"),
        (F.col("event_id") % 2).cast("int").alias("customer"),
        utc_date(start).alias("dt"),
        F.col("event_id").alias("eventId"),
    )


def assignment_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dominant and two rare ips per household, few clients, some empty."""
    event = F.col("event_id")
    rare_ip = F.when(event % 60 == 0, 1).when(event % 60 == 1, 2).otherwise(0)
    return _view(spark, sf_dir, F.col("user_id"), rare_ip, event % 7)


def assignment_input_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few households with many interleaved islands."""
    user = F.col("user_id")
    return _view(spark, sf_dir, user % 50, F.col("event_id") % 3, user)
