"""Mixing sources to target weights by systematic sampling.

A document's expected copies are the target of its source over the size of the source.
Within a source the documents stand in the order (size, md5 of the id, id); the expected
copies are summed along that order, one offset per source is added, and a document is
emitted once for each whole number its own step crosses. Sorting by size makes the draw a
stratified one, so the words taken come close to the target.

Sums are whole numbers of 1 / 2**24 copies: exact, and equal in every rerun.

No task sees a source as a whole. The order is cut into groups (source, size, first three
hex digits of the md5), documents per group are added up on the aggregated rows (bands of
sizes, sizes in a band, parts of a size), and only rows within one group are sorted together.
What a source's documents expect is joined last, from a written table of one row per source.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
a source of size 0 has target 0 and is not taken; repeated rows are rows of their own; a
null id is the empty id; an empty table gives an empty result; an input column named like
a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfold.llm.common import text_or_empty, word_count
from spanfold.sources.scratch import stored

UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
BAND_BITS = 6
RESULT = ("size", "source_size", "target", "copies", "taken")


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))


def _sum(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def targets(sizes: DataFrame, weights: Sequence[int], most_copies: int) -> DataFrame:
    """Per source (``_key``, ``_source``, ``source_size``) its target.

    Every source gets its weight's share of the total, at most ``most_copies`` times its
    size; what is above is shared again by weight. That is one water level: sources below
    it are full. One row per source, so one task orders them.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    full = (F.col("source_size") * most_copies).alias("_full")
    rows = sizes.withColumn("_weight", weight).withColumn("_full", full)
    rows = rows.withColumn("_ratio", F.col("_full") / F.col("_weight"))
    filled = Window.orderBy("_ratio", F.col("_source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(F.lit(1))
    rows = rows.select(
        "*",
        (
            (F.sum("source_size").over(whole) - _sum(F.col("_full"), filled))
            / (F.sum("_weight").over(whole) - _sum(F.col("_weight"), filled))
        ).alias("_level"),
    )
    level = F.min_by(
        F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")),
        F.when(F.col("_ratio") >= F.col("_level"), F.col("_ratio")),
    ).over(whole)
    return rows.select(
        "_key", "source_size",
        F.least(level * F.col("_weight"), F.col("_full").cast("double")).alias("target"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most_copies: int = 3, seed: str = "mix",
    text: str = "text", source: str = "source", doc_id: str = "doc_id", measured: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``measured`` may hold the same rows with their size as ``_size`` already, so that
    texts are counted once.
    """
    tie = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    if measured is None:
        measured = docs.withColumn("_size", word_count(text_or_empty(text)))
    kept = [c for c in docs.columns if c not in RESULT]
    rows = measured.select(
        F.struct(*kept).alias("_doc"), _source_key(source).alias("_key"), "_size", tie.alias("_tie"), F.substring(tie, 1, 3).alias("_part"),
        F.col(source).alias("_source"), F.col(doc_id).alias("_id"),
    )
    per_source = rows.groupBy("_key").agg(
        F.sum("_size").alias("source_size"), F.min("_source").alias("_source")
    )
    goals = targets(per_source, weights, most_copies).withColumn(
        "_units",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT))
        .otherwise(0).cast("long"),
    ).withColumn(
        "_offset",
        F.conv(F.substring(F.md5(F.concat(F.lit(seed), "_key").cast("binary")), 1, 6), 16, 10).cast("long"),
    )
    goals = stored(goals, "goals")  # a row per source; its size is known where it is joined
    group = ["_key", "_size", "_part"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    # documents before each size, by way of bands of sizes, so that no task orders a source's sizes
    band = F.shiftright("_size", BAND_BITS).alias("_band")
    sizes = counts.groupBy("_key", band, "_size").agg(F.sum("_n").alias("_n"))
    bands = sizes.groupBy("_key", "_band").agg(F.sum("_n").alias("_n"))

    def before(counted: DataFrame, by: Sequence[str], along: str, name: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        return counted.select(*by, along, _sum(F.col("_n"), earlier).alias(name))

    starts = (
        before(counts.withColumn("_band", band), ["_key", "_band", "_size"], "_part", "_in_size")
        .join(before(sizes, ["_key", "_band"], "_size", "_in_band"), ["_key", "_band", "_size"])
        .join(before(bands, ["_key"], "_band", "_smaller"), ["_key", "_band"])
        .select(*group, (F.col("_smaller") + F.col("_in_band") + F.col("_in_size")).alias("_before"))
    )
    within = Window.partitionBy(*group).orderBy("_tie", "_id")
    # all documents of a source expect equally many copies, so their sum follows from the rank
    rank = F.col("_before") + F.row_number().over(within)
    ranked = rows.join(starts, group).withColumn("_rank", rank).join(goals, "_key")
    end = F.col("_offset") + F.col("_rank") * F.col("_units")
    # a shift is exact where a division would go through doubles
    crossed = F.shiftright(end, UNIT_BITS) - F.shiftright(end - F.col("_units"), UNIT_BITS)
    return ranked.withColumn("copies", crossed).select(
        *[F.col("_doc")[c].alias(c) for c in kept],
        F.col("_size").alias("size"), "source_size", "target", "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves, each as often as its copies say."""
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    kept = [c for c in mixed.columns if c not in RESULT]
    taken = mixed.where(F.col("copies") > 0)
    return taken.select(F.struct(*kept).alias("doc"), F.explode(times)).select("doc.*")
