"""Comparing datasets by digests, so that what is equal is not moved and often not read.

The digest of a multiset of rows is its count and the sums of two 64-bit hashes of its rows (in
halves of 32 bits, so that sums are exact). It does not depend on the rows' order, a copy more
or less changes it, and it combines: partial digests are added up before their shuffle. Two
multisets that differ have equal digests with a chance of about 2**-128.

* Unordered: rows are dealt into buckets by their hash; a dataset is stored by bucket, its digests
  beside it. Only buckets whose digests differ are read, and compared row by row.
* In the order of the files: a row's position is its place in its file plus the rows of the
  files before. Positions are cut into chunks, the position is part of the hash, and only chunks
  whose digests differ are joined, by position. Nothing is sorted.

Columns must be comparable (no maps). NULLs are equal to each other, as in ``plans.diff``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanfold.plans.diff import dataset_diff
from spanfold.sources.scratch import stored

DIGEST = ("n", "a1", "a2", "b1", "b2")
ROWS_PER_CHUNK = 100_000


def _hashes(columns: Sequence[str | Column]) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def _sums(columns: Sequence[str | Column]) -> list[Column]:
    """Aggregates that make up the digest of the rows of a group."""
    found = [F.count(F.lit(1)).alias("n")]
    for name, h in zip("ab", _hashes(columns), strict=True):
        found += [
            F.sum(h.bitwiseAND(0xFFFFFFFF)).alias(f"{name}1"),
            F.sum(F.shiftrightunsigned(h, 32)).alias(f"{name}2"),
        ]
    return found


def unequal(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys whose digests differ, or that only one side has."""
    digest = F.struct(*DIGEST)
    both = left.select(key, digest.alias("l")).join(right.select(key, digest.alias("r")), key, "full_outer")
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select(key)


# -- as multisets ------------------------------------------------------------------------


def _bucket(columns: Sequence[str], n_buckets: int) -> Column:
    # a third hash: the digest sums run over all values of the others within a bucket
    return F.pmod(F.xxhash64(F.lit("bucket"), *columns), F.lit(n_buckets)).cast("int").alias("bucket")


def write_digested(df: DataFrame, path: str, n_buckets: int = 256) -> None:
    """Write a dataset by bucket, and the digest of each bucket. ``n_buckets`` must be the same
    for datasets that are to be compared. Copies of a row are all in one bucket, which the
    write splits over tasks if it is large."""
    columns = df.columns
    placed = df.select("*", _bucket(columns, n_buckets))
    placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    written = _rows(df.sparkSession, path, df.schema)
    written.groupBy("bucket").agg(*_sums(columns)).coalesce(1).write.parquet(f"{path}/digests")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField("bucket", T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{path}/rows")


def digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/digests")


def unequal_buckets(spark: SparkSession, expected: str, actual: str) -> list[int]:
    # bounded by the number of buckets
    found = unequal(digests(spark, expected), digests(spark, actual), "bucket").collect()
    return sorted(r.bucket for r in found)


def diff_stored(spark: SparkSession, expected: str, actual: str, schema: T.StructType) -> DataFrame:
    """``dataset_diff`` of two datasets written by ``write_digested``; reads only buckets that
    differ."""
    buckets = unequal_buckets(spark, expected, actual)
    sides = (
        _rows(spark, path, schema).where(F.col("bucket").isin(buckets)).drop("bucket")
        for path in (expected, actual)
    )
    return dataset_diff(*sides)


# -- in the order of the files -----------------------------------------------------------


def with_position_as_written(files: DataFrame) -> DataFrame:
    """Number the rows of a dataset from 0, as ``position``, in the order of its files by name and
    of the rows in them. ``files`` is a scan of parquet files, projected at most.

    What is counted per file comes from one further scan that reads no column."""
    path = F.col("_metadata.file_path")
    scanned = files.select("*", path.alias("_path"), F.col("_metadata.row_index").alias("_index"))
    counts = scanned.groupBy("_path").agg((F.max("_index") + 1).alias("_n"))
    # one row per file
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = stored(offsets, "file-offsets")
    return scanned.join(offsets, "_path").select(
        (F.col("_before") + F.col("_index")).alias("position"), *files.columns
    )


def ordered_diff_as_written(
    expected: DataFrame, actual: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Positions at which two scans of files differ, with both rows there; NULL past the end of
    the shorter one. Chunks with equal digests are not moved."""
    columns = expected.columns
    chunk = F.floor(F.col("position") / F.lit(rows_per_chunk)).alias("chunk")
    sides = [with_position_as_written(side.select(*columns)).select("*", chunk) for side in (expected, actual)]
    left, right = (stored(s.groupBy("chunk").agg(*_sums(["position", *columns])), "chunk-digests") for s in sides)
    wanted = stored(unequal(left, right, "chunk"), "unequal-chunks")
    rows = [
        side.join(wanted, "chunk", "left_semi").select("position", F.struct(*columns).alias(name))
        for side, name in zip(sides, ("expected", "actual"), strict=True)
    ]
    both = rows[0].hint("shuffle_hash").join(rows[1].hint("shuffle_hash"), "position", "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))
