"""Comparing datasets: as multisets, in order, and run against run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfold.sources.runs import Results
from spanfold.sources.scratch import stored

COPIES_PER_BLOCK = 10_000


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def _counted(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both sides in one grouping: copies combine before the shuffle, and NULLs
    compare equal, as a join on all columns would not do."""

    def side(df: DataFrame, n_expected: int, n_actual: int) -> DataFrame:
        return df.select(
            "*",
            F.lit(n_expected).cast("long").alias("nExpected"),
            F.lit(n_actual).cast("long").alias("nActual"),
        )

    return (
        side(expected, 1, 0)
        .unionByName(side(actual, 0, 1))
        .groupBy(*expected.columns)
        .agg(F.sum("nExpected").alias("nExpected"), F.sum("nActual").alias("nActual"))
    )


def dataset_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that do not occur equally often, with how often they do."""
    return _counted(expected, actual).where("nExpected <> nActual")


def first_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The least such row; no row when the datasets are equal."""
    return dataset_diff(expected, actual).orderBy(*expected.columns).limit(1)


def _copies(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spell out ``n`` copies of every row, numbered by ``block`` and ``copy``. A row
    with many copies is first spread over the tasks in blocks of them."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    few = counted.where(n <= COPIES_PER_BLOCK).select("*", zero.alias("block"), n.alias("size"))
    blocks = F.sequence(zero, F.floor((n - 1) / COPIES_PER_BLOCK))
    left = n - F.col("block") * COPIES_PER_BLOCK
    many = (
        counted.where(n > COPIES_PER_BLOCK)
        .select("*", F.explode(blocks).alias("block"))
        .withColumn("size", F.least(F.lit(COPIES_PER_BLOCK).cast("long"), left))
        .repartition(*columns, "block")
    )
    numbers = F.sequence(F.lit(1).cast("long"), "size")
    return few.unionByName(many).withColumn("copy", F.explode(numbers)).drop("n", "size")


def multiset_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The surplus rows themselves, copy by copy, and which side has them."""
    columns = expected.columns
    surplus = dataset_diff(expected, actual).select(
        F.when(F.col("nExpected") > F.col("nActual"), "expected").otherwise("actual").alias("side"),
        *columns,
        F.abs(F.col("nExpected") - F.col("nActual")).alias("n"),
    )
    return _copies(surplus, columns).select("side", *columns)


def _total_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """The sort key, then all other columns: what still ties is the same row."""
    return [*order_by, *[c for c in df.columns if c not in order_by]]


def with_position(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Number the rows of a dataset in order, from 0, as ``position``.

    Rows are spread over ranges of the order and numbered inside each range;
    then each range is moved by what lies before it. Copies of one row get copy
    numbers first and count as part of the order, so even a row that makes up a
    third of the data is spread over many ranges. The numbered ranges are written once:
    they must not be drawn anew between numbering and moving.
    """
    order = _total_order(df, order_by)
    key = [*order, "block", "copy"]
    numbered = (
        _copies(row_counts(df), order)
        .repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .withColumn("range", F.spark_partition_id())
        .withColumn("index", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .drop("block", "copy")
    )
    numbered = stored(numbered, "numbered")
    # one row per range, so this one-task window is bounded by the shuffle partitions
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    return numbered.join(offsets, "range").select(
        (F.col("before") + F.col("index")).alias("position"), *df.columns
    )


def ordered_diff(expected: DataFrame, actual: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Positions at which two ordered datasets differ, with both rows there; NULL
    past the end of the shorter one."""

    def side(df: DataFrame, name: str) -> DataFrame:
        placed = with_position(df.select(*expected.columns), order_by)
        return placed.select("position", F.struct(*expected.columns).alias(name))

    both = side(expected, "expected").join(side(actual, "actual"), "position", "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))


def first_ordered_difference(
    expected: DataFrame, actual: DataFrame, order_by: Sequence[str]
) -> DataFrame:
    """The first position at which two ordered datasets differ, without numbering
    or sorting them.

    In one total order both datasets agree up to the least row that does not
    occur equally often. Its position is what lies before it, plus the copies both
    sides have; there, one side holds this row and the other its next one.
    """
    row = F.struct(*_total_order(expected, order_by))
    counted = _counted(expected, actual).select(row.alias("row"), "nExpected", "nActual")
    counted = stored(counted, "counted")  # read twice
    least = counted.where("nExpected <> nActual").agg(F.min("row")).scalar()

    def row_there(mine: str, other: str) -> Column:
        surplus = (F.col("row") == F.col("least")) & (F.col(mine) > F.col(other))
        held = (F.col(mine) > 0) & ((F.col("row") > F.col("least")) | surplus)
        return F.min(F.when(held, F.col("row")))

    n_before = F.coalesce(F.sum(F.when(F.col("row") < F.col("least"), F.col("nExpected"))), F.lit(0))
    n_shared = F.max(F.when(F.col("row") == F.col("least"), F.least("nExpected", "nActual")))
    return (
        counted.withColumn("least", least)
        .agg(
            (n_before + n_shared).alias("position"),
            row_there("nExpected", "nActual").alias("expected"),
            row_there("nActual", "nExpected").alias("actual"),
        )
        .where("position IS NOT NULL")
    )


def compare_runs(expected: Mapping[str, DataFrame], actual: Mapping[str, DataFrame]) -> DataFrame:
    """Two runs' result tables, name by name: rows on each side and distinct rows
    that do not occur equally often."""

    def compared(name: str) -> DataFrame:
        counted = _counted(expected[name], actual[name])
        return counted.agg(
            F.coalesce(F.sum("nExpected"), F.lit(0)).alias("nExpected"),
            F.coalesce(F.sum("nActual"), F.lit(0)).alias("nActual"),
            F.count_if(F.col("nExpected") != F.col("nActual")).alias("nMismatched"),
        ).select(F.lit(name).alias("table"), "*")

    return reduce(DataFrame.unionByName, [compared(name) for name in expected])


def compare_exact(expected: Results, actual: Results) -> DataFrame:
    """Two validation runs over the same keys: their statistics, then their results row by
    row."""
    statistics = compare_statistics(expected, actual).withColumn(
        "table", F.concat(F.lit("statistics of "), "table")
    )
    return statistics.unionByName(compare_runs(expected.tables(), actual.tables()))


def compare_statistics(expected: Results, actual: Results) -> DataFrame:
    """Two validation runs whose ids may differ: only counts and statistics."""
    return compare_runs(expected.statistics(), actual.statistics())
