"""Client-id sets.

A client id is a list of ints. Inside the roll-up each id travels as one
string, because Spark de-duplicates arrays of strings by hash but compares
arrays of arrays pairwise (quadratic in the size of the set). The empty id is
the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_CLIENT = ""


def client_token(client_id: Column) -> Column:
    """``[1, 2]`` -> ``"1.2"``; an empty or NULL id -> ``""``."""
    joined = F.array_join(client_id.cast("array<string>"), ".")
    return F.coalesce(joined, F.lit(NO_CLIENT))


def client_ids(tokens: Column) -> Column:
    """Token set -> sorted ``array<array<int>>`` without the empty id."""
    named = F.filter(tokens, lambda t: t != NO_CLIENT)
    return F.array_sort(F.transform(named, lambda t: F.split(t, "\\.").cast("array<int>")))


def empty_only(tokens: Column) -> Column:
    """True when the set names no client; also true for the set without any id."""
    return ~F.exists(tokens, lambda t: t != NO_CLIENT)
