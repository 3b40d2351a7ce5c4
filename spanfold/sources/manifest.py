"""Publishing datasets together: data first, a manifest last, readers follow the manifest.

Data is written into fresh directories (generations) that no reader knows of yet. A version of
the manifest names, per dataset, the directories that make it up; it is one small file, and
its appearance is what publishes all of them at once. A job that stops at any point before
leaves the last version as it was. Two writers cannot publish the same version: the second
one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanfold.sources.files import Folder

VERSIONS = "_versions"


class PublishedMeanwhile(RuntimeError):
    """Another writer published the version that was to be published."""


@dataclass(frozen=True)
class Manifest:
    """``parts``: per dataset its directories, below the dataset's folder. ``figures``: numbers
    about the version. ``batches``: per source the last batch that went into it."""

    version: int = 0
    parts: Mapping[str, Sequence[str]] = field(default_factory=dict)
    figures: Mapping[str, int] = field(default_factory=dict)
    batches: Mapping[str, int] = field(default_factory=dict)

    def following(self) -> Manifest:
        return replace(self, version=self.version + 1)

    def with_parts(self, dataset: str, directories: Sequence[str]) -> Manifest:
        return replace(self, parts={**self.parts, dataset: list(directories)})


def _file(version: int) -> str:
    return f"{VERSIONS}/{version:012d}.json"


def versions(spark: SparkSession, folder: str) -> list[int]:
    names = Folder(spark, folder).names(VERSIONS)
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def at(spark: SparkSession, folder: str, version: int) -> Manifest:
    return Manifest(**json.loads(Folder(spark, folder).text(_file(version))))


def current(spark: SparkSession, folder: str) -> Manifest | None:
    known = versions(spark, folder)
    return at(spark, folder, known[-1]) if known else None


def publish(spark: SparkSession, folder: str, manifest: Manifest) -> Manifest:
    """``manifest`` must be one version after the current one."""
    fields = {"version": manifest.version, "parts": manifest.parts, "figures": manifest.figures, "batches": manifest.batches}
    files, name = Folder(spark, folder), _file(manifest.version)
    draft = f"{VERSIONS}/.{manifest.version}-{uuid.uuid4().hex}"
    try:
        files.create(name, json.dumps(fields), draft)
    except Py4JJavaError as error:
        if not files.exists(name):
            raise
        raise PublishedMeanwhile(f"{folder}, version {manifest.version}") from error
    return manifest


def generation(version: int) -> str:
    """A fresh directory for data of a version that is being prepared."""
    return f"gen={version:012d}-{uuid.uuid4().hex[:8]}"


def read(spark: SparkSession, folder: str, directories: Sequence[str], schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in the given directories, and only these are listed."""
    names = schema.fieldNames()
    if not directories:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/{d}" for d in directories]
    return spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*names)


def vacuum(spark: SparkSession, folder: str, datasets: Sequence[str], keep: int = 2) -> list[str]:
    """Remove generations that none of the last ``keep`` versions names; those of versions in
    preparation stay. ``datasets`` are folders below ``folder``, '' for itself."""
    known = versions(spark, folder)
    if not known:
        return []
    named = {d.split("/")[0] for v in known[-keep:] for ds in at(spark, folder, v).parts.values() for d in ds}
    files, gone = Folder(spark, folder), []
    for dataset in datasets:
        for name in files.names(dataset):
            old = name.startswith("gen=") and int(name[4:].split("-")[0]) <= known[-1]
            if old and name not in named:
                files.remove(f"{dataset}/{name}" if dataset else name)
                gone.append(name)
    for version in known[:-keep]:
        files.remove(_file(version))
    return gone
