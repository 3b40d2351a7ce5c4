import random

import pytest

from spanfold.plans import diff

SCHEMA = "k int, v string, a array<int>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


LEFT = [(1, "a", [1]), (1, "a", [1]), (2, None, []), (3, "c", None)]


def test_equal_datasets_in_any_order(spark):
    left, right = frame(spark, LEFT), frame(spark, LEFT[::-1])
    assert diff.dataset_diff(left, right).count() == 0
    assert diff.first_difference(left, right).count() == 0
    assert diff.multiset_difference(left, right).count() == 0
    assert diff.ordered_diff(left, right, ["k"]).count() == 0
    assert diff.first_ordered_difference(left, right, ["k"]).count() == 0


def test_copies_and_nulls_count(spark):
    left, right = frame(spark, LEFT), frame(spark, [LEFT[0], LEFT[2], LEFT[2], (9, "z", [0])])
    found = {(r.k, r.nExpected, r.nActual) for r in diff.dataset_diff(left, right).collect()}
    assert found == {(1, 2, 1), (2, 1, 2), (3, 1, 0), (9, 0, 1)}
    (first,) = diff.first_difference(left, right).collect()
    assert (first.k, first.nExpected, first.nActual) == (1, 2, 1)
    surplus = sorted((r.side, r.k) for r in diff.multiset_difference(left, right).collect())
    assert surplus == [("actual", 2), ("actual", 9), ("expected", 1), ("expected", 3)]


def test_positions_number_every_row(spark, monkeypatch):
    monkeypatch.setattr(diff, "COPIES_PER_BLOCK", 10)
    rows = [(7, "same", [1])] * 335 + [(i, "x", [i]) for i in range(1000)]
    random.Random(1).shuffle(rows)
    placed = diff.with_position(frame(spark, rows).repartition(5), ["k"])
    found = [(r.position, (r.k, r.v, r.a)) for r in placed.orderBy("position").collect()]
    assert [p for p, _ in found] == list(range(len(rows)))
    assert [r for _, r in found] == sorted(rows)


def brute_force(left, right):
    left, right = sorted(left), sorted(right)
    size = max(len(left), len(right))
    pad = [None]
    return [
        (i, a, b)
        for i, (a, b) in enumerate(zip(left + pad * (size - len(left)), right + pad * (size - len(right))))
        if a != b
    ]


@pytest.mark.parametrize("seed", range(4))
def test_ordered_diff_against_brute_force(spark, seed):
    rng = random.Random(seed)
    left = [(rng.randrange(20), rng.choice("abc"), [rng.randrange(2)]) for _ in range(120)]
    right = [r for i, r in enumerate(left) if i not in (3, 70)] + [left[5]] * (2 * (seed % 3))
    expected = brute_force(left, right)

    def plain(r):
        return r and (r.k, r.v, r.a)

    both = frame(spark, left), frame(spark, right)
    found = diff.ordered_diff(*both, ["k"]).orderBy("position").collect()
    assert [(r.position, plain(r.expected), plain(r.actual)) for r in found] == expected
    (first,) = diff.first_ordered_difference(*both, ["k"]).collect()
    assert (first.position, tuple(first.expected or ()), tuple(first.actual or ())) == (
        expected[0][0], expected[0][1] or (), expected[0][2] or (),
    )


def test_one_side_shorter(spark):
    left, right = frame(spark, LEFT[2:]), frame(spark, LEFT[2:3])
    (only,) = diff.first_ordered_difference(left, right, ["k"]).collect()
    assert (only.position, only.expected.k, only.actual) == (1, 3, None)
    (only,) = diff.ordered_diff(left, right, ["k"]).collect()
    assert (only.position, only.expected.k, only.actual) == (1, 3, None)


def test_one_shuffle_for_the_unordered_diff(spark):
    plan = diff.dataset_diff(frame(spark, LEFT), frame(spark, LEFT))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1
