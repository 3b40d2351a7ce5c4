"""Single operators on the cases known for each."""

import pytest
from notation import PLAIN, SLICED, expected_rows, fixed_slicer, folded_frame, folded_rows, parse, rows_frame
from pyspark.sql import functions as F

from spanfold.functions import clients as client_sets
from spanfold.functions import spans as span_functions
from spanfold.operators import absorb, islands, runs
from spanfold.operators.hot import Hot, Limits, find_hot, hot_groups, slice_table, slicer
from spanfold.plans.summary import household_timeline, merge_increment
from spanfold.sources.rows import spans

MINUTES = fixed_slicer(60_000)
FORMS = pytest.mark.parametrize("sliced", [False, True], ids=["plain", "sliced"])


def cases(table, side):
    return [p for name, case in table.items() for p in parse(case[side], name + "/")]


def check(spark, table, operator):
    result = operator(folded_frame(spark, cases(table, 0)))
    assert folded_rows(result) == expected_rows(cases(table, 1))


ISLANDS = {
    "touching": ("A:1[1,2] A:1[2,4]", "A:{1}[1,4]"),
    "point": ("A:1[2,2] A:2[2,4]", "A:{1,2}[2,4]"),
    "overlapping": ("A:2[2,4] A:1[1,3]", "A:{1,2}[1,4]"),
    "disjoint": ("A:1[1,2] A:1[3,4]", "A:{1}[1,2] A:{1}[3,4]"),
    "point inside": ("A:1[1,9] A:2[4,4] A:-[9,9]", "A:{1,2,-}[1,9]"),
    "long before short": ("A:1[1,90] A:2[5,6] A:3[50,60] A:4[91,92]", "A:{1,2,3}[1,90] A:{4}[91,92]"),
}


@pytest.mark.parametrize(
    "operator",
    [islands.islands, lambda df: islands.islands_sliced(df, MINUTES), islands.session_islands],
    ids=["plain", "sliced", "session"],
)
def test_islands(spark, operator):
    result = operator(spans(rows_frame(spark, cases(ISLANDS, 0))))
    assert folded_rows(result) == expected_rows(cases(ISLANDS, 1))


INCREMENTS = {
    "bridges both": ("A:{1}[1,2] A:{2}[1,3]", "A:{1,2}[1,2] A:{2}[3,4]", "A:{1,2}[1,4]"),
    "one side": ("A:{1}[1,3] A:{2}[1,5]", "A:{1,2}[2,4] A:{2}[6,7]", "A:{1,2}[1,5] A:{2}[6,7]"),
    "chain": (
        "A:{1}[1,3] A:{3}[4,5]",
        "A:{1,2}[2,4] A:{2}[6,7] A:{2}[8,9]",
        "A:{1,2,3}[1,5] A:{2}[6,7] A:{2}[8,9]",
    ),
    "disjoint": ("A:{1}[1,2]", "A:{2}[3,4]", "A:{1}[1,2] A:{2}[3,4]"),
}


@FORMS
def test_merge_increment(spark, sliced):
    old, new, merged = ([p for n, c in INCREMENTS.items() for p in parse(c[i], n + "/")] for i in range(3))
    both = folded_frame(spark, old), folded_frame(spark, new)
    hot = find_hot(both[0].unionByName(both[1]), SLICED if sliced else PLAIN)
    assert (hot == Hot()) == (not sliced)
    result = merge_increment(*both, hot)
    assert folded_rows(result) == expected_rows(merged)


RUNS = {
    "three": (
        "A:{1}[3,4] B:{2}[4,6] B:{3}[1,2]", "B:{3}[1,2] A:{1}[3,4] B:{2}[4,6]",
    ),
    "neighbours": (
        "A:{1}[1,4] B:{2}[4,6] B:{3}[1,2] A:{2}[2,7]", "B:{3}[1,2] A:{1,2}[1,7] B:{2}[4,6]",
    ),
    "gap": ("A:{1}[1,2] A:{2}[2,3] A:{3}[5,7]", "A:{1,2,3}[1,7]"),
}


@FORMS
def test_runs(spark, sliced):
    check(spark, RUNS, lambda df: runs.runs_sliced(df, MINUTES) if sliced else runs.runs(df))


@FORMS
def test_runs_are_numbered_in_time_order(spark, sliced):
    given = folded_frame(spark, parse("A:{1}[1,2] A:{1}[3,4] B:{1}[5,6] A:{1}[7,8] A:{1}[9,9]"))
    numbered = runs.runs_sliced(given, MINUTES) if sliced else runs.runs(given)
    result = numbered.orderBy("start").collect()
    assert [(r.ip, r.run) for r in result] == [(10, 1), (20, 2), (10, 3)]


ABSORB = {
    "two empty ones": ("A:{}[1,2] A:{-}[2,3] A:{3}[5,7]", "A:{3,-}[1,7]"),
    "per ip": (
        "A:{}[1,2] B:{1}[2,3] A:{3}[3,4] B:{-}[4,5] C:{1,2,3}[7,7]",
        "A:{3}[1,4] B:{1,-}[2,5] C:{1,2,3}[7,7]",
    ),
    "other ip": ("A:{}[1,2] B:{3}[5,7]", "A:{}[1,2] B:{3}[5,7]"),
    "named and empty": ("A:{}[1,2] A:{3,-}[5,7]", "A:{3,-}[1,7]"),
    "all named": ("A:{1}[1,2] A:{2}[2,3] A:{3}[5,7]", "A:{1}[1,2] A:{2}[2,3] A:{3}[5,7]"),
    "one": ("A:{}[1,2]", "A:{}[1,2]"),
    "later wins": ("A:{1}[1,2] A:{-}[5,6] A:{2}[9,10]", "A:{1}[1,2] A:{2,-}[5,10]"),
    "trailing": ("A:{1}[1,2] A:{-}[5,6] A:{}[8,9]", "A:{1,-}[1,9]"),
}


@FORMS
def test_absorb(spark, sliced):
    check(spark, ABSORB, lambda df: absorb.absorb_sliced(df, MINUTES) if sliced else absorb.absorb(df))


@FORMS
def test_timeline_order(spark, sliced):
    given = "A:1[2,3] B:1[2,2] C:1[1,4] A:1[0,1] B:1[5,5] A:1[5,5] C:1[5,5]"
    result = household_timeline(rows_frame(spark, parse(given)), SLICED if sliced else PLAIN)
    found = [(r.ip, r.start // 60000, r.end // 60000) for r in result.orderBy("position").collect()]
    assert found == [
        (10, 0, 1), (30, 1, 4), (20, 2, 2), (10, 2, 3), (10, 5, 5), (20, 5, 5), (30, 5, 5),
    ]


def test_only_empty_sets(spark):
    sets = spark.createDataFrame(
        [([], True), ([""], True), (["3"], False), (["3", ""], False)], "s array<string>, e boolean"
    )
    assert sets.where(client_sets.empty_only(F.col("s")) != F.col("e")).count() == 0


def test_span_functions(spark):
    table = spark.createDataFrame(
        [
            # start, end, other start, other end, overlap, first covers second
            (1, 2, 2, 4, True, False),
            (1, 2, 3, 4, False, False),
            (1, 4, 2, 2, True, True),
            (1, 4, 1, 4, True, True),
            (2, 2, 2, 2, True, True),
            (5, 7, 1, 3, False, False),
        ],
        "s long, e long, os long, oe long, o boolean, c boolean",
    )
    cols = [F.col(c) for c in ("s", "e", "os", "oe")]
    assert table.where(span_functions.covers(*cols) != F.col("c")).count() == 0


def test_hot_households(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.col("id").cast("string")).alias("householdId"),
        (F.col("id") % 7).alias("ip"),
    )

    def found(rows, limit):
        return [r.householdId for r in hot_groups(rows, ["householdId"], limit).collect()]

    assert found(rows, 500) == ["big"]
    assert found(rows, 5000) == []
    assert found(rows.where("false"), 1) == []


def test_every_hot_group_is_found(spark):
    """200 large households among many ordinary ones; 1,500 hot households, all pairs hot."""
    few = spark.range(200 * 60 + 3000).select(
        F.when(F.col("id") < 200 * 60, F.concat(F.lit("big"), F.col("id") % 200))
        .otherwise(F.col("id").cast("string")).alias("householdId"),
        (F.col("id") % 3).cast("int").alias("ip"), (F.col("id") * 1000).alias("start"),
    )
    assert find_hot(few, Limits(hot_rows=60, slice_rows=20)).households.count() == 200
    many = spark.range(1500 * 6).select(
        (F.col("id") % 1500).cast("string").alias("householdId"),
        F.lit(1).alias("ip"), (F.col("id") * 1000).alias("start"),
    )
    hot = find_hot(many, Limits(hot_rows=6, slice_rows=2))
    assert hot.households.count() == 1500 and hot.pair_slices.count() == 1500
    assert hot.rows.count() == 1500 * 6


def test_client_sets_combine_before_they_are_collected(spark):
    """A run of 100,000 islands of the same 50 clients."""
    given = spark.range(100_000).select(
        F.lit("h").alias("householdId"), F.lit(1).alias("ip"), (F.col("id") * 10).alias("start"),
        (F.col("id") * 10 + 1).alias("end"),
        F.transform(F.sequence(F.lit(0), F.lit(49)), lambda c: c.cast("string")).alias("clients"),
    )
    merged = runs.runs(given)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set(client" in plan
    (row,) = merged.collect()
    assert (row.start, row.end, len(row.clients)) == (0, 999_991, 50)


@pytest.mark.parametrize("n_slices", [5, 200])
def test_slices_are_even_and_in_time_order(spark, n_slices):
    # half of the rows in a hundredth of the time
    rows = spark.range(20_000).select(
        F.lit("h").alias("householdId"),
        F.when(F.col("id") % 2 == 0, F.col("id") * 5_000).otherwise(F.col("id") * 50 + 20_000_000).alias("start"),
    )
    table = slice_table(rows, ["householdId"], 20_000 // n_slices)
    sliced = slicer(table, ["householdId"])(rows).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("start").alias("lo"), F.max("start").alias("hi")
    ).orderBy("slice").collect()
    assert abs(len(sliced) - n_slices) <= n_slices // 5
    assert max(s.n for s in sliced) < 3 * 20_000 // n_slices + 400
    assert all(a.hi < b.lo for a, b in zip(sliced, sliced[1:]))


def test_find_hot(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.col("id").cast("string")).alias("householdId"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 300).otherwise(7).cast("int").alias("ip"),
        (F.col("id") * 1000).alias("start"),
    )
    assert find_hot(rows, Limits(hot_rows=5000)) == Hot()
    hot = find_hot(rows, Limits(hot_rows=900, slice_rows=100))
    assert [r.householdId for r in hot.households.collect()] == ["big"] and hot.pair_slices is None
    hot = find_hot(rows, Limits(hot_rows=400, slice_rows=100))
    (pair,) = hot.pair_slices.collect()
    assert (pair.householdId, pair.ip) == ("big", 7)
    assert len(pair.blocks[0]) == 5  # 500 rows in slices of 100
