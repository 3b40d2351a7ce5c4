"""Coalescing the overlapping spans of one household and ip into islands.

Input: ``<keys>, ip, start, end`` and either ``client`` (one token per row) or
``clients`` (a token set per row, as in the output). Output: one row per island,
``<keys>, ip, start, end, clients``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfold.operators.hot import Step
from spanfold.sources.scratch import stored

HOUSEHOLD = ("householdId",)


def islands(spans: DataFrame, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """Window form. A span opens an island when it starts after everything
    before it has ended. Needs rows of a group in one task; adds no exchange to
    a frame already partitioned by ``keys``.
    """
    group = [*keys, "ip"]
    ordered = Window.partitionBy(*group).orderBy("start")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max("end").over(before)
    opened = F.when(F.coalesce(F.col("start") > reach, F.lit(True)), F.col("start"))
    placed = spans.withColumn("opened", opened).withColumn("island", F.max("opened").over(so_far))
    return merged_spans(placed, [*group, "island"]).drop("island")


def islands_sliced(
    spans: DataFrame, add_slice: Step, keys: Sequence[str] = HOUSEHOLD
) -> DataFrame:
    """The same islands with a group spread over its time slices.

    Spans of equal start, which no slicing can part, are combined first. Islands are
    then built inside each slice and joined with what earlier slices reach: one
    small row per slice.
    """
    group = [*keys, "ip"]
    starts = merged_spans(spans.withColumn("at", F.col("start")), [*group, "at"]).drop("at")
    local = stored(islands(add_slice(starts), [*keys, "slice"]), "sliced-islands")

    by_slice = Window.partitionBy(*group).orderBy("slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("lastStart") > F.col("reachBefore"), F.lit(True))
    goes_on = F.lead("firstStart").over(by_slice) <= F.greatest("reach", "reachBefore")
    carried = (
        local.groupBy(*group, "slice")
        .agg(
            F.max("end").alias("reach"),
            F.min("start").alias("firstStart"),
            F.max("start").alias("lastStart"),
        )
        .withColumn("reachBefore", F.max("reach").over(earlier))
        .withColumn("opened", F.when(opens, F.col("lastStart")))
        .withColumn("openBefore", F.max("opened").over(earlier))
        .withColumn("extended", F.when(goes_on, F.coalesce("opened", "openBefore")))
        .select(*group, "slice", "reachBefore", "openBefore", "extended")
    )
    continues = F.coalesce(F.col("start") <= F.col("reachBefore"), F.lit(False))
    placed = local.join(carried, [*group, "slice"]).withColumn(
        "island", F.when(continues, F.col("openBefore")).otherwise(F.col("start"))
    )
    crosses = continues | F.col("start").eqNullSafe(F.col("extended"))
    return stitched(placed, crosses, [*group, "island"]).drop("island")


def stitched(parts: DataFrame, crosses: Column, group: Sequence[str]) -> DataFrame:
    """Parts that cross a slice bound are merged, all others stay as they are."""
    whole = parts.where(~crosses).select(*group, "start", "end", "clients")
    return whole.unionByName(merged_spans(parts.where(crosses), group))


def merged_spans(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group: its full extent and the union of its clients. Works on
    single ids, which combine before the shuffle, so that a group of many parts is
    never more than its distinct ids in one place."""
    client = F.col("client") if "client" in parts.columns else F.explode_outer("clients").alias("client")
    return (
        parts.select(*group, "start", "end", client)
        .groupBy(*group)
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.collect_set("client").alias("clients"),
        )
    )


def with_event_time(spans: DataFrame) -> DataFrame:
    return spans.withColumn("at", F.timestamp_millis(F.col("start")))


def session_islands(spans: DataFrame, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """The same islands through ``session_window``. The window is half-open, so
    one millisecond more makes touching spans one session. This is the form that
    also runs on a stream, where the caller adds ``at`` and its watermark first.
    """
    timed = spans if "at" in spans.columns else with_event_time(spans)
    length = F.concat((F.col("end") - F.col("start") + 1).cast("string"), F.lit(" milliseconds"))
    return (
        timed.groupBy(*keys, "ip", F.session_window("at", length).alias("session"))
        .agg(F.collect_set("client").alias("clients"))
        .select(
            *keys,
            "ip",
            F.unix_millis("session.start").alias("start"),
            (F.unix_millis("session.end") - 1).alias("end"),
            "clients",
        )
    )
