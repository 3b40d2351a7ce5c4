"""A stored summary that takes increments.

Besides the summary its islands are kept, because runs and absorption need a household's whole
timeline while islands can be merged with new ones. Both datasets are spread over buckets of
households, a directory each. An increment

1. is folded into islands by itself,
2. is merged with the stored islands of the buckets it touches,
3. has the households it touches folded anew from their islands to summary rows; other
   households of these buckets keep theirs,
4. is published as new directories for the touched buckets. Other buckets are neither read
   nor written.

Rows that were added before change nothing, so an increment may be repeated; one that carries
the number of its batch is not even folded again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanfold.operators.hot import Hot, Limits
from spanfold.plans.summary import (
    ABSORB,
    ISLANDS,
    LIMITS,
    RUNS,
    fold_spans,
    merge_increment,
    summarize,
)
from spanfold.sources import manifest as published
from spanfold.sources.manifest import Manifest
from spanfold.sources.rows import spans
from spanfold.sources.scratch import stored
from spanfold.sources.sink import MAX_RECORDS_PER_FILE, SUMMARY_SCHEMA

ISLAND_SCHEMA = T.StructType(
    [
        T.StructField("householdId", T.StringType()),
        T.StructField("ip", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("clients", T.ArrayType(T.StringType())),
    ]
)
TABLES = {"islands": ISLAND_SCHEMA, "summary": SUMMARY_SCHEMA}


@dataclass(frozen=True)
class SummaryStore:
    """``n_buckets`` is fixed for the life of a store. A bucket should fit a few tasks."""

    spark: SparkSession
    path: str
    n_buckets: int = 1_024

    def manifest(self) -> Manifest:
        return published.current(self.spark, self.path) or Manifest()

    def summary(self) -> DataFrame:
        return self._read("summary", self.manifest())

    def islands(self) -> DataFrame:
        return self._read("islands", self.manifest())

    def add(
        self, rows: DataFrame, hot: Limits | Hot = LIMITS, source: str | None = None, batch: int | None = None
    ) -> Manifest:
        """Fold further rows in. With ``source`` and ``batch``, a batch that is not after the last
        one of its source is left out."""
        before = self.manifest()
        if source is not None and batch is not None and batch <= before.batches.get(source, -1):
            return before
        found = spans(rows)
        increment = stored(
            ISLANDS.on_hot(found, Hot.of(found, hot)).withColumn("bucket", self._bucket()), "increment"
        )
        # bounded by the number of buckets
        touched = sorted(r[0] for r in increment.select("bucket").distinct().collect())
        after = before.following()
        if source is not None and batch is not None:
            after = replace(after, batches={**before.batches, source: batch})
        if touched:
            after = self._merged(increment.drop("bucket"), touched, before, after, hot)
        return published.publish(self.spark, self.path, after)

    def _merged(
        self, increment: DataFrame, touched: Sequence[int], before: Manifest, after: Manifest, hot: Limits | Hot
    ) -> Manifest:
        limits = LIMITS if isinstance(hot, Hot) else hot
        households = stored(increment.select("householdId").distinct(), "touched-households")
        after = self._write(
            "islands", merge_increment(self._read("islands", before, touched), increment, limits), touched, after
        )
        islands = self._read("islands", after, touched).join(households, "householdId", "left_semi")
        anew = summarize(fold_spans(islands, [RUNS, ABSORB], limits))
        others = self._read("summary", before, touched).join(households, "householdId", "left_anti")
        return self._write("summary", anew.unionByName(others), touched, after)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("householdId"), F.lit(self.n_buckets)).cast("int")

    def _read(self, table: str, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        parts = manifest.parts.get(table, [])
        if buckets is not None:
            wanted = {f"bucket={b}" for b in buckets}
            parts = [p for p in parts if p.split("/")[-1] in wanted]
        return published.read(self.spark, f"{self.path}/{table}", parts, TABLES[table])

    def _write(self, table: str, rows: DataFrame, touched: Sequence[int], manifest: Manifest) -> Manifest:
        generation = published.generation(manifest.version)
        placed = rows.select(*TABLES[table].fieldNames(), self._bucket().alias("bucket"))
        # evens out tasks and splits a bucket that is too large for one file
        placed.hint("rebalance", "bucket").write.option(
            "maxRecordsPerFile", MAX_RECORDS_PER_FILE
        ).partitionBy("bucket").parquet(f"{self.path}/{table}/{generation}")
        replaced = {f"bucket={b}" for b in touched}
        kept = [p for p in manifest.parts.get(table, []) if p.split("/")[-1] not in replaced]
        return manifest.with_parts(table, [*kept, *(f"{generation}/bucket={b}" for b in touched)])
