"""Reading assignment rows.

On disk: parquet below one base directory, partitioned by ``customer`` and
``dt``, rows of the hourly grain by ``hour`` as well. Which customers, days and hours to
read are predicates on those columns, so Spark opens only the matching directories.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanfold.functions.clients import client_token

# Fixed values.
UNKNOWN_HOUSEHOLD = "0"
SUMMARY_VERSION = "0.0.1"

TIME_SPAN = T.StructType(
    [T.StructField("startTimeMs", T.LongType()), T.StructField("endTimeMs", T.LongType())]
)
CLIENT_ID = T.ArrayType(T.IntegerType())

ROW_SCHEMA = T.StructType(
    [
        T.StructField("ip", T.IntegerType()),
        T.StructField("clientId", CLIENT_ID),
        T.StructField("timeSpan", TIME_SPAN),
        T.StructField("householdId", T.StringType()),
        T.StructField("status", T.ByteType()),
        T.StructField("version", T.StringType()),
    ]
)
LAYOUT_SCHEMA = T.StructType(
    [*ROW_SCHEMA.fields, T.StructField("customer", T.IntegerType()), T.StructField("dt", T.DateType())]
)

HOURLY_SCHEMA = T.StructType([*LAYOUT_SCHEMA.fields, T.StructField("hour", T.IntegerType())])


def conform(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Bind by name to the row schema: cast, order and drop everything else."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ROW_SCHEMA.fields], *extra
    )


def known_households(df: DataFrame) -> DataFrame:
    """Drop rows of the unknown household, and those with no household at all."""
    return df.where(F.col("householdId") != UNKNOWN_HOUSEHOLD)


def utc(t: datetime) -> datetime:
    """An aware instant in UTC; one without a zone is UTC already."""
    return t if t.tzinfo is None else t.astimezone(timezone.utc).replace(tzinfo=None)


def in_window(
    customers: Sequence[int], start: datetime, end: datetime, grain: str = "Daily"
) -> Column:
    """Rows of the customers in all days (or hours) that the instants from ``start`` up
    to, not including, ``end`` touch. Only partition columns are compared."""
    start, end = utc(start), utc(end)
    step = timedelta(hours=1) if grain == "Hourly" else timedelta(days=1)
    first = start.replace(minute=0, second=0, microsecond=0)
    last = (end - timedelta(microseconds=1)).replace(minute=0, second=0, microsecond=0)
    if grain != "Hourly":
        first, last = first.replace(hour=0), last.replace(hour=0)
    if last < first:
        last = first - step  # an empty window
    day, wanted = F.col("dt"), F.col("customer").isin(*customers)
    from_day, to_day = (F.lit(t.date()) for t in (first, last))
    wanted &= (day >= from_day) & (day <= to_day)
    if grain == "Hourly":
        wanted &= (day > from_day) | (F.col("hour") >= first.hour)
        wanted &= (day < to_day) | (F.col("hour") <= last.hour)
    return wanted


def read_window(
    spark: SparkSession, base: str, customers: Sequence[int], start: datetime, end: datetime,
    grain: str = "Daily",
) -> DataFrame:
    """With the schema given, no file footer is opened to merge schemas: a column a
    file lacks is NULL."""
    layout = HOURLY_SCHEMA if grain == "Hourly" else LAYOUT_SCHEMA
    table = spark.read.schema(layout).parquet(base)
    rows = known_households(table.where(in_window(customers, start, end, grain)))
    return conform(rows, extra=("customer", "dt"))


def read_paths(spark: SparkSession, base: str, paths: Sequence[str]) -> DataFrame:
    """Read chosen directories with whatever columns their files have between them;
    columns encoded in the path below ``base`` survive."""
    table = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*paths)
    return known_households(table)


def union_customers(slices: Sequence[DataFrame]) -> DataFrame:
    """By name, so that slices may differ in column order or lack a late column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)


def is_usable() -> Column:
    """A row can be placed on a timeline: it has an ip and a span that does not end
    before it starts. Never NULL."""
    start, end = F.col("timeSpan.startTimeMs"), F.col("timeSpan.endTimeMs")
    return F.col("ip").isNotNull() & F.coalesce(start <= end, F.lit(False))


def rejects(rows: DataFrame) -> DataFrame:
    """Rows the roll-up leaves out; the job keeps them next to its summary."""
    return rows.where(~is_usable())


def spans(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The roll-up's input: usable rows of known households, flattened."""
    return known_households(rows).where(is_usable()).select(
        "householdId",
        *extra,
        "ip",
        F.col("timeSpan.startTimeMs").alias("start"),
        F.col("timeSpan.endTimeMs").alias("end"),
        client_token(F.col("clientId")).alias("client"),
    )
