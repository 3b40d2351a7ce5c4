"""Comparisons by digest against plain ones, and what they read."""

import random

import pytest

from spanfold.plans import digest
from spanfold.plans.diff import dataset_diff
from spanfold.sources.files import Folder

SCHEMA = "a int, b string, c array<int>"


def rows(seed, n=300):
    chance = random.Random(seed)
    return [
        (chance.choice([None, 1, 2]), chance.choice([None, "", "x", "y"]), chance.choice([None, [], [1], [1, 2]]))
        for _ in range(n)
    ]


def shown(df):
    return sorted(str(r) for r in df.collect())


def written(spark, found, path):
    df = spark.createDataFrame(found, SCHEMA)
    digest.write_digested(df, str(path), 8)
    return df


@pytest.mark.parametrize("change", ["none", "copy", "lost", "value", "all", "empty"])
def test_multisets(spark, tmp_path, change):
    left = rows(1)
    right = {
        "none": left[::-1], "copy": [*left, left[0]], "lost": left[1:],
        "value": [(9, "new", []), *left[1:]], "all": rows(2), "empty": [],
    }[change]
    sides = [written(spark, side, tmp_path / name) for side, name in ((left, "l"), (right, "r"))]
    paths = [str(tmp_path / name) for name in "lr"]
    found = digest.diff_stored(spark, *paths, sides[0].schema)
    assert shown(found) == shown(dataset_diff(*sides))
    unequal = digest.unequal_buckets(spark, *paths)
    assert len(unequal) <= {"none": 0, "copy": 1, "lost": 1, "value": 2}.get(change, 8)


def test_equal_buckets_are_not_read(spark, tmp_path):
    left = [(n, str(n), None) for n in range(200)]
    written(spark, left, tmp_path / "l")
    written(spark, [*left[:-1], (-1, "", None)], tmp_path / "r")
    schema = spark.createDataFrame([], SCHEMA).schema
    unequal = digest.unequal_buckets(spark, str(tmp_path / "l"), str(tmp_path / "r"))
    for side in "lr":
        folder = Folder(spark, f"{tmp_path}/{side}/rows")
        for name in folder.names():
            if name.startswith("bucket=") and int(name[7:]) not in unequal:
                folder.remove(name)  # whoever reads it now misses rows
    found = digest.diff_stored(spark, str(tmp_path / "l"), str(tmp_path / "r"), schema)
    assert sorted((r.a, r.nExpected, r.nActual) for r in found.collect()) == [(-1, 0, 1), (199, 1, 0)]
    assert found.inputFiles() and all(
        any(f"bucket={b}/" in f for b in unequal) for f in found.inputFiles()
    )


def in_files(spark, found, path, per_file):
    spark.createDataFrame(found, SCHEMA).coalesce(1).write.option("maxRecordsPerFile", per_file).parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("change", ["none", "value", "longer", "inserted", "empty"])
def test_order_of_the_files(spark, tmp_path, change):
    left = rows(3, 200)
    right = {
        "none": left, "value": [*left[:77], (5, "z", [7]), *left[78:]], "longer": [*left, (1, "x", [])],
        "inserted": [left[0], (5, "z", [7]), *left[1:]], "empty": [],
    }[change]
    sides = in_files(spark, left, tmp_path / "l", 30), in_files(spark, right, tmp_path / "r", 45)
    found = digest.ordered_diff_as_written(*sides, rows_per_chunk=16)

    def plain(row):
        return None if row is None else tuple(row)

    at = range(max(len(left), len(right)))
    expected = {
        n: (left[n] if n < len(left) else None, right[n] if n < len(right) else None) for n in at
    }
    assert {r.position: (plain(r.expected), plain(r.actual)) for r in found.collect()} == {
        n: pair for n, pair in expected.items() if pair[0] != pair[1]
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_digests_combine_on_the_map_side(spark, tmp_path):
    df = in_files(spark, rows(4), tmp_path / "l", 50)
    placed = digest.with_position_as_written(df)
    assert [r.position for r in placed.orderBy("position").collect()] == list(range(300))
    assert [tuple(r)[1:] for r in placed.orderBy("position").collect()] == rows(4)
