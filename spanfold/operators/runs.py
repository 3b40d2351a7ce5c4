"""A household's timeline, and runs of neighbouring islands that share an ip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spanfold.operators.hot import Step
from spanfold.operators.islands import HOUSEHOLD, merged_spans, stitched
from spanfold.sources.scratch import stored


def _chronological(keys: Sequence[str]) -> WindowSpec:
    # ip breaks ties of equal spans, which makes the runs deterministic
    return Window.partitionBy(*keys).orderBy("start", "end", "ip")


def _earlier_slices(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("slice")


def timeline(islands: DataFrame, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """Number a household's islands in time order over all its ips."""
    return islands.withColumn("position", F.row_number().over(_chronological(keys)).cast("long"))


def timeline_sliced(
    islands: DataFrame, add_slice: Step, keys: Sequence[str] = HOUSEHOLD
) -> DataFrame:
    local = stored(timeline(add_slice(islands), [*keys, "slice"]), "sliced-timeline")
    earlier = _earlier_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        local.groupBy(*keys, "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n")
    )
    return (
        local.join(offsets, [*keys, "slice"])
        .withColumn("position", F.col("position") + F.col("before"))
        .drop("slice", "before")
    )


def runs(islands: DataFrame, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
    """Merge islands that follow each other on one ip, over any gap. ``run``
    numbers a household's runs in time order."""
    order = _chronological(keys)
    turn = F.when(F.lag("ip").over(order).eqNullSafe(F.col("ip")), 0).otherwise(1)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = islands.withColumn("turn", turn).withColumn("run", F.sum("turn").over(so_far))
    return merged_spans(numbered, [*keys, "ip", "run"])


def runs_sliced(
    islands: DataFrame, add_slice: Step, keys: Sequence[str] = HOUSEHOLD
) -> DataFrame:
    """The same runs, built inside each time slice first. The first run of a slice
    goes on with the last one of the slice before when they share an ip."""
    local = stored(runs(add_slice(islands), [*keys, "slice"]), "sliced-runs")
    by_slice = _earlier_slices(keys)
    continues = F.coalesce(F.lag("lastIp").over(by_slice) == F.col("firstIp"), F.lit(False))
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        local.groupBy(*keys, "slice")
        .agg(
            F.min_by("ip", "run").alias("firstIp"),
            F.max_by("ip", "run").alias("lastIp"),
            F.max("run").alias("n"),
        )
        .withColumn("continued", continues.cast("long"))
        .withColumn("before", F.coalesce(F.sum(F.col("n") - F.col("continued")).over(earlier), F.lit(0)))
        .withColumn("goesOn", F.coalesce(F.lead("continued").over(by_slice), F.lit(0)))
        .select(*keys, "slice", "continued", "before", "n", "goesOn")
    )
    first, last = F.col("run") == 1, F.col("run") == F.col("n")
    crosses = (first & (F.col("continued") == 1)) | (last & (F.col("goesOn") == 1))
    placed = (
        local.join(carried, [*keys, "slice"])
        .withColumn("crosses", crosses)
        .withColumn("run", F.col("before") + F.col("run") - F.col("continued"))
    )
    return stitched(placed, F.col("crosses"), [*keys, "ip", "run"])
