"""Spans in short form.

``HH1 A:1[11,12] B:-[21,22]``: household, then ip, client id (``-`` for the empty
one) and span in minutes. Client sets are written ``{1,2}``, ``{1,-}`` or ``{}``.
"""

import re

from pyspark.sql import functions as F

from spanfold.functions.clients import NO_CLIENT
from spanfold.operators.hot import Limits
from spanfold.sources.rows import ROW_SCHEMA

PLAIN = Limits(hot_rows=10**12)
SLICED = Limits(hot_rows=1, slice_rows=2)
# only the larger households, or their larger ips
PARTLY = Limits(hot_rows=60, slice_rows=7)
IPS = {"A": 10, "B": 20, "C": 30}
MINUTE = 60_000
ITEM = re.compile(r"([ABC]):(\{[^}]*\}|[-\d]+)\[(\d+),(\d+)\]")


def parse(text, prefix=""):
    """[(household, ip, client names, start, end)]"""
    household, found = prefix + "HH1", []
    for word in text.split():
        item = ITEM.fullmatch(word)
        if item is None:
            household = prefix + word
            continue
        ip, clients, start, end = item.groups()
        names = [c for c in clients.strip("{}").split(",") if c]
        found.append((household, IPS[ip], names, int(start) * MINUTE, int(end) * MINUTE))
    return found


def row(household, ip, client, start, end):
    ids = [] if client == "-" else [int(client)]
    return (ip, ids, (start, end), household, 0, "0.0.1")


def rows_frame(spark, parsed):
    rows = [row(hh, ip, names[0], s, e) for hh, ip, names, s, e in parsed]
    return spark.createDataFrame(rows, ROW_SCHEMA)


def folded_frame(spark, parsed):
    """Islands or runs, as the operators pass them on."""
    data = [
        (hh, ip, s, e, [NO_CLIENT if n == "-" else n for n in names])
        for hh, ip, names, s, e in parsed
    ]
    schema = "householdId string, ip int, start bigint, end bigint, clients array<string>"
    return spark.createDataFrame(data, schema)


def folded_rows(df):
    return sorted(
        (r.householdId, r.ip, sorted("-" if c == NO_CLIENT else c for c in r.clients), r.start, r.end)
        for r in df.collect()
    )


def summary_rows(df):
    return sorted(
        (
            r.householdId, r.ip, [str(c[0]) for c in r.clientIds],
            r.timeSpan.startTimeMs, r.timeSpan.endTimeMs,
        )
        for r in df.collect()
    )


def expected_rows(parsed):
    return sorted((hh, ip, sorted(names), s, e) for hh, ip, names, s, e in parsed)


def fixed_slicer(slice_ms):
    """Slices of one width."""
    return lambda df: df.withColumn("slice", F.floor(F.col("start") / F.lit(slice_ms)))
