"""Document fingerprints by winnowing, in SQL functions only.

A text is cut into tokens: each character of a script written without spaces is one, other
runs without white space are cut every 24 characters. Every run of ``gram`` tokens has a
hash, built up by doubling from the tokens' hashes: runs of 1, 2, 4 tokens and the one
after. In every window of ``window`` neighbouring hashes the smallest is chosen, of equals
the rightmost, and kept with its position. So any run of gram + window - 1 tokens that two
texts share has a common chosen hash, and none shorter than ``gram`` tokens can match.

Hash and position travel in one number, hash above and the distance of the position from
the largest possible one below, so that the least number is the least hash and, of equals,
the rightmost position. Window minima come from doubling too.

Defined cases: a null text is read as empty; an empty one, or one of white space, has an
empty fingerprint; a text with fewer tokens than a run is one run, one with fewer runs than
a window is one window. Two empty fingerprints have likeness 1. Texts of any length are
read whole. Repeated rows are rows of their own. Input columns named like result columns
are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spanfold.llm.common import text_or_empty

MOST_RANGES = 4_096
RANGE_ROWS = 500
GRAM = 5
WINDOW = 4
POSITION_BITS = 31
LAST = (1 << POSITION_BITS) - 1
# Scripts written without spaces between words.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{UNSPACED}]|[^\s{UNSPACED}]{{1,24}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _paired(values: Column, shift: int, pair: Callable[[Column, Column], Column]) -> Column:
    """``pair`` of each value and the one ``shift`` later; fewer by ``shift``."""
    count = F.size(values) - shift
    return F.zip_with(F.slice(values, 1, count), F.slice(values, shift + 1, count), pair)


def _doubled(
    values: Column, reached: int, goal: int, pair: Callable[[Column, Column], Column],
    then: Callable[[Column], Column],
) -> Column:
    """``pair`` over runs of ``goal`` neighbours, from runs of ``reached``."""
    if reached == goal:
        return then(values)
    shift = min(reached, goal - reached)
    return _let(
        _paired(values, shift, pair), lambda longer: _doubled(longer, reached + shift, goal, pair, then)
    )


def _packed(grams: Column) -> Column:
    return F.transform(
        grams,
        lambda h, at: F.shiftleft(h.bitwiseAND(0xFFFFFFFF), POSITION_BITS) + (F.lit(LAST) - at),
    )


def winnowed(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Chosen hashes of a text with their positions, packed, in order of position."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    nothing = F.array().cast("array<bigint>")

    def choose(packed: Column) -> Column:
        return F.when(F.size(packed) < window, F.array(F.array_min(packed))).otherwise(
            _doubled(packed, 1, window, lambda a, b: F.least(a, b), F.array_distinct)
        )

    def grams(hashes: Column) -> Column:
        few = F.array(F.xxhash64(hashes))
        many = _doubled(hashes, 1, gram, lambda a, b: F.xxhash64(a, b), lambda found: found)
        return F.when(F.size(hashes) < gram, few).otherwise(many)

    return _let(
        tokens,
        lambda hashes: F.when(F.size(hashes) == 0, nothing).otherwise(
            _let(_packed(grams(hashes)), choose)
        ),
    )


def shown(packed: Column) -> Column:
    """``hash:position`` joined by commas."""
    parts = F.transform(
        packed,
        lambda p: F.concat_ws(
            ":", F.shiftright(p, POSITION_BITS), F.lit(LAST) - p.bitwiseAND(LAST)
        ),
    )
    return F.array_join(parts, ",")


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of the sets of chosen hashes."""

    def hashes(packed: Column) -> Column:
        return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, POSITION_BITS)))

    both = F.array(hashes(left), hashes(right))

    def ratio(sets: Column) -> Column:
        return _let(
            F.size(F.array_intersect(sets[0], sets[1])),
            lambda common: F.when(F.size(sets[0]) + F.size(sets[1]) == 0, F.lit(1.0)).otherwise(
                common / (F.size(sets[0]) + F.size(sets[1]) - common)
            ),
        )

    return _let(both, ratio)


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of a text column."""
    return docs.withColumn(out, shown(winnowed(text_or_empty(text))))


def with_next(
    docs: DataFrame, doc_id: str, columns: Sequence[str], then: Callable[[DataFrame, WindowSpec], DataFrame]
) -> DataFrame:
    """What ``then`` makes of ``docs`` and a window in which the following row is the one
    with the next larger id (after the last: the first).

    The ids are cut at approximate quantiles (actual ids, at most ``MOST_RANGES``), each
    range is a window partition of its own, and the first row of a range is also put at the
    end of the range before. So rows are shuffled once, and no task orders all of them.
    Rows with equal ids follow each other by ``columns``; rows without an id stand alone.
    """
    rows = docs.select(doc_id).where(F.col(doc_id).isNotNull())
    count = rows.count()
    ranges = max(1, min(MOST_RANGES, count // RANGE_ROWS))
    shares = [k / ranges for k in range(ranges)]
    found = rows.agg(F.percentile_approx(doc_id, shares, 20 * MOST_RANGES).alias("ids"),
                     F.min(doc_id).alias("first")).first()
    bounds = sorted({found["first"], *(found["ids"] or [])} - {None})
    cuts = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    halves = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    # binary search for the last cut that is not above the id
    at = F.aggregate(
        F.array(*map(F.lit, halves)), F.lit(0),
        lambda reached, step: F.when(
            F.get(cuts, reached + step) <= F.col(doc_id), reached + step
        ).otherwise(reached),
    )
    spread = -1 - F.pmod(F.xxhash64(*columns), F.lit(ranges)).cast("int")
    placed = docs.withColumn("_range", F.when(F.col(doc_id).isNull(), spread).otherwise(at))
    before = F.pmod(F.col("_range") - 1, F.lit(max(1, len(bounds))))
    opens = F.coalesce(F.get(cuts, "_range") == F.col(doc_id), F.lit(False))
    here = F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy"))
    there = F.struct(before.alias("range"), F.lit(True).alias("copy"))
    placed = placed.withColumn(
        "_place", F.explode(F.when(opens, F.array(here, there)).otherwise(F.array(here)))
    ).select(*docs.columns, "_place.range", F.col("_place.copy").alias("_copy"))
    placed = placed.withColumnRenamed("range", "_range")
    order = Window.partitionBy("_range").orderBy("_copy", doc_id, *columns)
    return then(placed, order).where(~F.col("_copy")).drop("_range", "_copy")


def edited_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document its fingerprint, that of its text with the last quarter replaced by the
    begin of the next document, and how alike they are; and its likeness to the next."""
    rows = docs.select(doc_id, text_or_empty(text).alias("_text"))

    def compared(placed: DataFrame, order: WindowSpec) -> DataFrame:
        following = F.when(F.col(doc_id).isNotNull(), F.lead("_text").over(order))
        placed = placed.withColumn("_next", F.coalesce(following, F.lit("")))
        placed = placed.withColumn("n_chars", F.length("_text").cast("long"))
        quarter = F.shiftright(F.length("_text"), 2)
        placed = placed.withColumn(
            "_edited",
            F.concat(
                F.substring("_text", F.lit(1), F.length("_text") - quarter),
                F.substring("_next", F.lit(1), quarter),
            ),
        ).drop("_next")
        placed = placed.withColumn("_own", winnowed(F.col("_text")))
        placed = placed.withColumn(
            "_following", F.when(F.col(doc_id).isNotNull(), F.lead("_own").over(order))
        )
        placed = placed.where(~F.col("_copy")).withColumn("_changed", winnowed(F.col("_edited")))
        empty = F.array().cast("array<bigint>")
        return placed.select(
            doc_id, "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
            shown(F.col("_own")).alias("fingerprint"), shown(F.col("_changed")).alias("edited_fingerprint"),
            likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
            likeness(F.col("_own"), F.coalesce("_following", empty)).alias("near_next"),
            "_range", "_copy",
        )

    return with_next(rows, doc_id, ["_text"], compared)
