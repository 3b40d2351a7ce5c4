"""Validation runs that are kept: their result tables and statistics, by name of the run.

A run is written into a folder of its own and published last, with what it was a run of. Runs
are compared from what is stored, without the rows and summaries they came from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from spanfold.sources import manifest as published
from spanfold.sources.files import Folder
from spanfold.sources.manifest import Manifest


class Results(Protocol):
    def tables(self) -> dict[str, DataFrame]: ...

    def statistics(self) -> dict[str, DataFrame]: ...


@dataclass(frozen=True)
class StoredRun:
    """What a validation run found."""

    name: str
    figures: dict[str, int]
    _tables: dict[str, DataFrame] = field(repr=False)
    _statistics: dict[str, DataFrame] = field(repr=False)

    def tables(self) -> dict[str, DataFrame]:
        return self._tables

    def statistics(self) -> dict[str, DataFrame]:
        return self._statistics


@dataclass(frozen=True)
class RunStore:
    spark: SparkSession
    path: str

    def names(self) -> list[str]:
        """Runs that were published whole."""
        return [n for n in Folder(self.spark, self.path).names() if published.versions(self.spark, f"{self.path}/{n}")]

    def save(self, name: str, run: Results, **figures: int) -> StoredRun:
        """Keep a run under a new name, or as a new version of that name."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.=-]*", name):
            raise ValueError(f"no name for a folder: {name}")
        folder = f"{self.path}/{name}"
        after = (published.current(self.spark, folder) or Manifest()).following()
        generation = published.generation(after.version)
        after = replace(after, parts={}, figures=figures)
        for kind, frames in (("tables", run.tables()), ("statistics", run.statistics())):
            for table, df in frames.items():
                place = f"{generation}/{kind}/{table.replace(' ', '_')}"
                df.write.parquet(f"{folder}/{place}")
                after = after.with_parts(f"{kind}/{table}", [place])
        published.publish(self.spark, folder, after)
        return self.load(name)

    def load(self, name: str, version: int | None = None) -> StoredRun:
        folder = f"{self.path}/{name}"
        found = (
            published.current(self.spark, folder) if version is None
            else published.at(self.spark, folder, version)
        )
        if found is None:
            raise KeyError(f"no run {name}")
        sides: dict[str, dict[str, DataFrame]] = {"tables": {}, "statistics": {}}
        for key, (place,) in found.parts.items():
            kind, table = key.split("/", 1)
            sides[kind][table] = self.spark.read.parquet(f"{folder}/{place}")
        return StoredRun(name, dict(found.figures), sides["tables"], sides["statistics"])
