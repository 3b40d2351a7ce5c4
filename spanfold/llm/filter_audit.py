"""Audit of how document filters interact: what each removes, alone and after others.

Five filters fail a document: A, it has few words; B, few of its words are distinct; C, many of
its characters are capitals; D, it holds a mark of code or tables; E, a document with a smaller
id has the very same text.

E is an existential self-join. The documents whose text hash occurs under several ids meet, on
that hash, one row per distinct text with its smallest id; a left semi-join on hash, exact text
and smaller id keeps those that fail. That side has one row however many copies there are, so
a text that makes up a third of the documents is no quadratic work, and its copies, the other
side, are split freely over tasks. Hashes that occur once take no part, and no text of theirs
moves when the repeated hashes are few enough to be broadcast (the optimizer sees the size of
the written table).

The failures found there are united with those of the other filters: a document marked E
counts out of the combination of its other bits and into the same one with E. So what is
aggregated is bits, and from then on there are at most 32 combinations x 4 labels per part.

All 120 orders follow from the combinations. What is left after some filters depends on their
set and not on their order, so per part 32 numbers (documents that fail none of a set) answer
every order and step: a step removes the difference of two of them. A filter's Shapley sum is
the same difference over all sets without the filter, times the orders that place just these
before it.

Defined cases: a null text is an empty one (no words: it fails A, and neither B, C nor D); all
empty texts are copies of each other; a null source is the part ''; words and capitals are
counted in the whole text; rows that repeat id and text are documents of their own, none a copy
of the other, but each is one if a smaller id has the text; a null id is smaller or larger than
none; an id with several labels has a label if any row says so; documents without a label are
neither good nor toxic; an empty table gives no rows. Only id, text and source are read, so
further columns do not matter.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.llm.common import text_or_empty
from spanfold.sources.scratch import stored

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
IDENTICAL = 1 << FILTERS.index("E")
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
MARKS = "[#$%&*|]"


def own_failures(text: Column) -> Column:
    """Bits of the filters that need no other document: A is 1, B 2, C 4, D 8."""
    # the six separators as one, which splits without a regular expression
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", " " * 5), " "), "")
    n_words = F.size(words)
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = (
        n_words < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n_words,
        100 * capitals.cast("long") > MOST_CAPITALS * F.length(text),
        text.rlike(MARKS),
    )
    bits = [F.when(fails, 1 << n).otherwise(0) for n, fails in enumerate(failed)]
    return sum(bits[1:], bits[0]).cast("int")


def identical_to_smaller(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """The rows of ``docs`` (id, text, hash and more) whose text a smaller id has too.
    ``hashed`` has id and hash of the same rows."""
    ids = hashed.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    repeated = stored(ids.where("least < most").select("hash"), "repeated-hashes")
    shared = docs.join(repeated, "hash", "left_semi")
    least = stored(
        shared.where("id is not null").groupBy("hash", "text").agg(F.min("id").alias("least")), "texts"
    )
    return shared.alias("d").join(
        least.alias("t"),
        (F.col("d.hash") == F.col("t.hash")) & (F.col("d.text") == F.col("t.text"))
        & (F.col("d.id") > F.col("t.least")),
        "left_semi",
    )


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, good, toxic, n): documents per part, failed filters and labels."""
    texts = docs.select("id", "part", "text", F.xxhash64("text").alias("hash"))
    own = texts.select("id", "part", "hash", own_failures(F.col("text")).alias("bits"))
    own = stored(own, "failures")
    identical = identical_to_smaller(texts, own.select("id", "hash")).select(
        "id", "part", own_failures(F.col("text")).alias("bits")
    )
    moves = F.explode(
        F.array(
            F.struct(F.col("bits"), F.lit(-1).alias("n")),
            F.struct((F.col("bits") + IDENTICAL).alias("bits"), F.lit(1).alias("n")),
        )
    )
    failures = own.select("id", "part", "bits", F.lit(1).alias("n")).unionByName(
        identical.select("id", "part", moves.alias("move")).select("id", "part", "move.*")
    )
    known = labels.where("id is not null").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    labelled = failures.join(known, "id", "left")
    no = F.lit(False)
    return labelled.groupBy(
        "part", "bits", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    ).agg(F.sum("n").alias("n"))


def orders(spark: SparkSession) -> DataFrame:
    """(filter_order, step, filter, before, after): a fixed table of 600 rows. ``before`` and
    ``after`` are the sets of filters applied up to the step."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            rows.append(f"('{name}', {step}, {f}, {before}, {before | 1 << f})")
            before |= 1 << f
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS o(filter_order, step, filter, before, after)")


def _at(counts: str, key: Column) -> Column:
    return F.coalesce(F.try_element_at(counts, key), F.lit(0).cast("long"))


def _shapley(f: int) -> Column:
    """What filter ``f`` removes, summed over all orders."""
    terms = []
    for others in range(SETS):
        if others >> f & 1:
            continue
        size = others.bit_count()
        times = factorial(size) * factorial(len(FILTERS) - 1 - size)
        terms.append((_at("left", F.lit(others)) - _at("left", F.lit(others | 1 << f))) * times)
    return sum(terms[1:], terms[0])


def interactions(combined: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    n = F.col("n")
    # every set of filters none of which the combination fails
    sets = F.filter(
        F.sequence(F.lit(0), F.lit(SETS - 1)), lambda s: s.bitwiseAND(F.col("bits")) == 0
    )
    per_set = combined.select("part", "good", "toxic", "n", F.explode(sets).alias("set")).groupBy(
        "part", "set"
    ).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )

    def counts(column: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("set", column)))

    left = per_set.groupBy("part").agg(
        counts("n").alias("left"), counts("good").alias("good"), counts("toxic").alias("toxic")
    )
    alone = combined.where(F.bit_count("bits") == 1).groupBy("part").pivot(
        "bits", [1 << f for f in range(len(FILTERS))]
    ).agg(F.sum("n"))
    alone = alone.toDF("part", *(f"alone{f}" for f in range(len(FILTERS))))
    per_filter = F.array(
        *(
            F.struct(
                F.lit(f).alias("filter"),
                F.coalesce(F.col(f"alone{f}"), F.lit(0)).alias("unique_fails"),
                _shapley(f).alias("shapley"),
                (_at("left", F.lit(0)) - _at("left", F.lit(1 << f))).alias("fails"),
            )
            for f in range(len(FILTERS))
        )
    )
    parts = left.join(alone, "part", "left").select(
        "part", "left", "good", "toxic", F.explode(per_filter).alias("f")
    ).select("part", "left", "good", "toxic", "f.*")
    steps = parts.join(F.broadcast(orders(combined.sparkSession)), "filter")

    def removed(counts: str) -> Column:
        return _at(counts, F.col("before")) - _at(counts, F.col("after"))

    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        _at("left", F.col("after")).alias("kept"),
        removed("left").alias("removed"),
        (F.col("fails") - removed("left")).alias("redundant"),
        "unique_fails",
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        "shapley",
    )


def audit(
    docs: DataFrame, labels: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per part, order of the filters and step."""
    rows = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text).alias("text"),
    )
    known = labels.select(F.col(doc_id).alias("id"), "quality", "toxic")
    return interactions(stored(combinations(rows, known), "combinations"))
