"""Finding households too large for one task, and cutting them into time slices.

A household's timeline is ordered, so the plain operators keep each household
(or each of its ips) in one task. Groups above a row limit take the sliced forms
instead: their time axis is cut into slices of about equal row counts and each
slice is worked on by itself. Both forms give the same rows; what is found here
only chooses the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfold.sources.scratch import stored

SLICES_PER_BLOCK = 32
TICK_MS = 10_000

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Limits:
    """Rows from which a group is hot, and rows to aim at per slice."""

    hot_rows: int = 1_000_000
    slice_rows: int = 200_000


@dataclass(frozen=True)
class Hot:
    """Hot households, and the (household, ip) pairs among their rows that are hot
    by themselves; each with its slice table. All are written tables: nothing here
    is bounded in number, and what is small is broadcast by the optimizer."""

    households: DataFrame | None = None
    household_slices: DataFrame | None = None
    pair_slices: DataFrame | None = None
    rows: DataFrame | None = None
    """The rows of hot households, of the frame they were looked for in."""

    @classmethod
    def of(cls, spans: DataFrame, given: Limits | Hot) -> Hot:
        """What was found before, or what there is to find."""
        return replace(given, rows=None) if isinstance(given, Hot) else find_hot(spans, given)

    def by_household(self, df: DataFrame, plain: Step, sliced: Step) -> DataFrame:
        if self.households is None:
            return plain(df)
        on = ["householdId"]
        of_hot = df.join(self.households, on, "left_semi") if self.rows is None else self.rows
        return plain(df.join(self.households, on, "left_anti")).unionByName(sliced(of_hot))

    def by_pair(self, df: DataFrame, plain: Step, sliced: Step) -> DataFrame:
        if self.pair_slices is None:
            return plain(df)
        pairs = self.pair_slices.select("householdId", "ip")
        on = ["householdId", "ip"]
        return plain(df.join(pairs, on, "left_anti")).unionByName(
            sliced(df.join(pairs, on, "left_semi"))
        )


def hot_groups(rows: DataFrame, group: Sequence[str], hot_rows: int) -> DataFrame:
    """Groups with at least ``hot_rows`` rows, all of them. Rows are counted exactly, and
    combine before the shuffle."""
    return (
        rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot_rows)
        .select(*group)
    )


def slice_table(spans: DataFrame, group: Sequence[str], slice_rows: int) -> DataFrame:
    """``<group>, blocks``: where each group's slices begin, in blocks of bounds.

    Counts rows per tick of time, which combines before its shuffle, and cuts
    where the running count passes a whole number of slices. A slice is as narrow as
    it must be where rows are dense, down to one tick.
    """
    ticks = spans.groupBy(
        *group, F.floor(F.col("start") / F.lit(TICK_MS)).alias("tick")
    ).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / slice_rows)
    bounds = (
        ticks.withColumn("number", number)
        .groupBy(*group, "number")
        .agg((F.min("tick") * TICK_MS).alias("bound"))
        .withColumn("rank", F.row_number().over(whole.orderBy("bound")) - 1)
    )
    blocks = bounds.groupBy(*group, F.floor(F.col("rank") / SLICES_PER_BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list("bound")).alias("bounds")
    )
    return blocks.groupBy(*group).agg(F.array_sort(F.collect_list("bounds")).alias("blocks"))


def slicer(table: DataFrame, group: Sequence[str]) -> Step:
    """A step that numbers the slice each span starts in: the block first, then the
    slice in it, so that a row is compared with few of the bounds."""

    def add_slice(df: DataFrame) -> DataFrame:
        start = F.col("start")
        block = F.greatest(F.size(F.filter("blocks", lambda b: b[0] <= start)), F.lit(1)) - 1
        inside = F.size(F.filter(F.get("blocks", block), lambda bound: bound <= start))
        number = F.coalesce(block * SLICES_PER_BLOCK + inside, F.lit(0))
        # left, so that a group the table does not know is one slice and not lost
        return df.join(table, list(group), "left").select(
            *df.columns, number.alias("slice")
        )

    return add_slice


def find_hot(spans: DataFrame, limits: Limits) -> Hot:
    """Look for hot households: one pass over one column. If there are any, their rows
    are written once, and their pairs, slices and the roll-up read that table."""
    household, pair = ["householdId"], ["householdId", "ip"]
    households = stored(hot_groups(spans, household, limits.hot_rows), "hot-households")
    if households.isEmpty():
        return Hot()
    rows = stored(spans.join(households, household, "left_semi"), "hot-rows")
    rows_of_pairs = rows.join(hot_groups(rows, pair, limits.hot_rows), pair, "left_semi")
    pair_slices = stored(slice_table(rows_of_pairs, pair, limits.slice_rows), "pair-slices")
    return Hot(
        households,
        stored(slice_table(rows, household, limits.slice_rows), "household-slices"),
        None if pair_slices.isEmpty() else pair_slices,
        rows,
    )
