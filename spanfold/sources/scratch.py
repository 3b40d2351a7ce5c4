"""A folder every executor sees, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only where it is unset, and the
    session is a local one, a temporary folder takes its place."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spanfold-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/spanfold-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. Frames that still read one of
    them can be used no more, so this is for the owner of a run, at its end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(folder, True)


@contextmanager
def _freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run here remove their shuffle files at their end. Else these stay until
    the driver happens to collect its garbage, all steps' files side by side."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several queries read, and go on from the written table:
    it is computed once, pruned by column, and outlives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with _freeing_shuffles(spark):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def release(*written: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, before the end of a run. For whoever wrote them and
    has read them for the last time: frames over them can be used no more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
