"""Closed-interval arithmetic on epoch-millisecond columns.

A span holds both of its end points, so touching spans overlap and a span
covers itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def covers(outer_start: Column, outer_end: Column, start: Column, end: Column) -> Column:
    return (outer_start <= start) & (end <= outer_end)


def time_span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("startTimeMs"), end.alias("endTimeMs"))


def utc_date(ms: Column) -> Column:
    """Calendar day of an epoch-millisecond column, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))
