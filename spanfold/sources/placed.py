"""Datasets placed by household, so that what compares them shuffles nothing.

Each dataset is written as a table of buckets by household, with the same number of buckets.
Groupings by household (and more) and joins on household then work bucket by bucket where the
rows already are: the datasets pay one exchange when they are stored, and none for each check.

A bucket is one task's work, so households above a row limit are kept out of the buckets, in a
table of their own. ``over`` runs a plan on the bucketed parts and, where there are hot
households, once more on theirs, in the ordinary way with its exchanges and skew handling. The two
share no household, so their results are united.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.operators.hot import Limits
from spanfold.sources.scratch import fresh_path, stored

HOUSEHOLD = "householdId"


@dataclass(frozen=True)
class Placed:
    """``hot`` has the same names as ``bucketed``, or none where no household is hot."""

    spark: SparkSession
    n_buckets: int
    bucketed: Mapping[str, DataFrame]
    hot: Mapping[str, DataFrame]
    hot_households: DataFrame | None
    tables: Mapping[str, str]

    def over(
        self, plan: Callable[..., DataFrame], *names: str, hot: Callable[..., DataFrame] | None = None
    ) -> DataFrame:
        """``plan`` takes the named datasets and must treat each household by itself. ``hot`` is
        another plan of the same result, for households that are large."""
        found = plan(*[self.bucketed[n] for n in names])
        if self.hot:
            found = found.unionByName((hot or plan)(*[self.hot[n] for n in names]))
        return found

    def whole(self, name: str) -> DataFrame:
        """A dataset with its hot households."""
        return self.over(lambda df: df, name)

    def with_derived(self, name: str, plan: Callable[..., DataFrame], *names: str) -> Placed:
        """Store what ``plan`` makes of datasets that are placed. Its rows stay in their buckets:
        no exchange."""
        table, frame = _bucket_table(plan(*[self.bucketed[n] for n in names]), name, self.n_buckets)
        hot = {}
        if self.hot:
            hot = {**self.hot, name: stored(plan(*[self.hot[n] for n in names]), f"hot-{name}")}
        return Placed(
            self.spark, self.n_buckets, {**self.bucketed, name: frame}, hot, self.hot_households,
            {**self.tables, name: table},
        )

    def with_placed(self, name: str, df: DataFrame) -> Placed:
        """Store a further dataset beside the others, at the price of its exchange."""
        ordinary, hot = df, {}
        if self.hot_households is not None:
            ordinary = df.join(self.hot_households, HOUSEHOLD, "left_anti")
            of_hot = df.join(self.hot_households, HOUSEHOLD, "left_semi")
            hot = {**self.hot, name: stored(of_hot, f"hot-{name}")}
        table, frame = _bucket_table(ordinary.repartition(self.n_buckets, HOUSEHOLD), name, self.n_buckets)
        return Placed(
            self.spark, self.n_buckets, {**self.bucketed, name: frame}, hot, self.hot_households,
            {**self.tables, name: table},
        )

    def drop(self) -> None:
        """Forget the tables; their files go with the scratch folder."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _bucket_table(df: DataFrame, name: str, n_buckets: int) -> tuple[str, DataFrame]:
    spark, table = df.sparkSession, f"placed_{name}_{uuid.uuid4().hex}"
    writer = df.write.option("path", fresh_path(spark, f"placed-{name}"))
    writer.bucketBy(n_buckets, HOUSEHOLD).sortBy(HOUSEHOLD).saveAsTable(table)
    return table, spark.table(table)


def place(df: DataFrame, name: str, n_buckets: int = 200, limits: Limits | None = None) -> Placed:
    """Place a first dataset. Its rows per household say which households are hot."""
    limits = limits or Limits()
    counts = df.groupBy(HOUSEHOLD).agg(F.count(F.lit(1)).alias("n"))
    hot = stored(counts.where(F.col("n") >= limits.hot_rows).select(HOUSEHOLD), "hot-households")
    households = None if hot.isEmpty() else hot
    return Placed(df.sparkSession, n_buckets, {}, {}, households, {}).with_placed(name, df)
