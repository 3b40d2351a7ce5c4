"""What several operators share: table reading, words, stable splits."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six ASCII characters.
GAPS = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a missing id counts as an empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(of))


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, computed in the JVM."""
    gaps = F.size(F.split(text, GAPS, -1))
    blank_start = F.when(text.rlike(r"\A[ \t\n\x0B\f\r]"), 1).otherwise(0)
    blank_end = F.when(text.rlike(r"[ \t\n\x0B\f\r]\z"), 1).otherwise(0)
    count = F.when(F.length(text) == 0, 0).otherwise(
        F.greatest(gaps - blank_start - blank_end, F.lit(0))
    )
    return count.cast("long")


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece stay below a size, or are a single one."""
    sizes = batch.column(column)
    begin, total = 0, 0
    for row in range(batch.num_rows):
        value = sizes[row]
        size = value.as_buffer().size if value.is_valid else 0
        if total and total + size > most_bytes:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(work: Work) -> Work:
    """A Python worker serves many tasks of many stages. At the end of each of this kind it
    gives freed memory back to the system, which else stays with it."""

    @wraps(work)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return tidied


def give_back() -> None:
    """Freed memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
