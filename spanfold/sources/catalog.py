"""The input layout as a catalog table with registered partitions.

Reading a base directory lists every customer and day below it before a predicate can leave any
out. A catalog table knows its partitions: the predicate picks them there, and only the
directories of those that are left are listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from spanfold.sources.files import Folder
from spanfold.sources.rows import (
    HOURLY_SCHEMA,
    LAYOUT_SCHEMA,
    conform,
    in_window,
    known_households,
)

PARTITIONS_PER_STATEMENT = 500


def _partition_columns(grain: str) -> tuple[str, ...]:
    return ("customer", "dt", "hour") if grain == "Hourly" else ("customer", "dt")


def create(spark: SparkSession, table: str, base: str, grain: str = "Daily") -> None:
    """A table over a base directory that knows no partition yet."""
    schema = HOURLY_SCHEMA if grain == "Hourly" else LAYOUT_SCHEMA
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(_partition_columns(grain))
    location = base.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{location}'")


def register(spark: SparkSession, table: str, partitions: Iterable[Mapping[str, object]]) -> None:
    """Make partitions known, as whoever writes them does; a known one stays as it is."""

    def spec(partition: Mapping[str, object]) -> str:
        def literal(value: object) -> str:
            return f"DATE '{value}'" if isinstance(value, date) else str(int(value))

        return "PARTITION (" + ", ".join(f"{k} = {literal(v)}" for k, v in partition.items()) + ")"

    specs = [spec(p) for p in partitions]
    for begin in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        some = " ".join(specs[begin : begin + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")


def partitions_of(spark: SparkSession, base: str, customers: Sequence[int], grain: str = "Daily") -> list[dict]:
    """The partitions that the directories of some customers hold, to register them once."""
    found: list[dict] = []

    def below(folder: str, known: dict, columns: Sequence[str]) -> None:
        if not columns:
            found.append(known)
            return
        name, *rest = columns
        for child in Folder(spark, folder).names():
            if child.startswith(f"{name}="):
                text = child.split("=", 1)[1]
                value = date.fromisoformat(text) if name == "dt" else int(text)
                below(f"{folder}/{child}", {**known, name: value}, rest)

    for customer in customers:
        below(f"{base}/customer={customer}", {"customer": customer}, _partition_columns(grain)[1:])
    return found


def read_window(
    spark: SparkSession, table: str, customers: Sequence[int], start: datetime, end: datetime,
    grain: str = "Daily",
) -> DataFrame:
    """Rows of the customers in all days (or hours) that the window touches."""
    rows = known_households(spark.table(table).where(in_window(customers, start, end, grain)))
    return conform(rows, extra=("customer", "dt"))
