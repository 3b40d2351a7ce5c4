"""Ranked lexical search: Block-Max MaxScore over index shards.

``build`` cuts documents into shards of bounded text. A shard is one row: its documents in
order of their ids, and per term a list of (document, occurrences) in blocks of 128, encoded as
bytes of variable length. Beside each block stand its last document and its best pairs of
occurrences and document length: those that no other posting of the block beats in both. What a
posting adds to a score grows with the one and falls with the other, so the block's maximum is
that of its best pairs, whatever the totals of the corpus are by then. Shards depend on nothing
but their own documents. All that a shard holds is bytes, numbers in seven bits each, and shards
cross to Python one at a time: as arrays of whole numbers a row was three times as large, and the
JVM and Arrow held several rows side by side, each more than once.

``search`` takes items in groups, finds the weight of each of their terms by adding up list
sizes over all shards, and reads each shard once per group. In a shard, an item's lists are
ordered by their largest possible part of a score. Lists whose sum of largest parts is below the
tenth best score so far are non-essential: no document that stands in them alone can be among
the best. Candidates come from the essential lists, in stretches of documents. Then, from the
largest non-essential list to the smallest, candidates are dropped if what they have, the maximum of
the block they would be in and the parts of the lists that are left stay below the tenth best
score; only blocks that still have a candidate are decoded. Best lists go on from shard to
shard of a task; the tasks' lists are merged by rank.

Scores are whole numbers, so the order does not depend on how the work is cut. Documents with
the tenth best score are never dropped unseen, so that ties go by id.

Defined cases: a null text has no term; documents without a term are in no result and count
in no total; rows that repeat an id are documents of their own; documents with a null id
come after all others of their score; rows with one item_id are one item with the terms of all;
an item without a term has no row; texts of any length are read whole (one may make a shard
by itself); an empty table gives an empty result. Only ids and texts are read, so further
columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanfold.llm.common import give_back, text_or_empty, tidy
from spanfold.sources.scratch import stored

TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
SHARD_BYTES = 8 << 20
BLOCK = 128
STRETCH = 1_024
BEST = 10
GROUP_ITEMS = 512
NO_ID = np.iinfo(np.int64).max

# Postings of which a shard is encoded at once.
SLICE = 1 << 16
# Rows of a table that cross to or from a Python worker at once: texts, shards, and terms of a shard.
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_A_BATCH, SHARDS_A_BATCH, TERMS_A_BATCH = 500, 1, 1 << 14

# What ``packed`` writes; beside them the ids as they are, the terms' bytes and the postings.
_PACKED = ("lengths", "term_bytes", "sizes", "lasts", "block_bytes", "pairs", "pair_tfs", "pair_lengths")
_BYTES = ("doc_ids", "terms", *_PACKED, "data")
SHARD = "docs long, words long, " + ", ".join(f"{name} binary" for name in _BYTES)


def terms_of(text: bytes) -> list[bytes]:
    """Only A to Z are lower-cased; a term is a run of ASCII letters and digits and of
    anything beyond ASCII."""
    return TERMS(text.lower())


# -- the encoding of postings --------------------------------------------------------


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers in seven bits a byte, the last byte of each marked; and their sizes."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        sizes += values >= 1 << bits
    ends = np.cumsum(sizes)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    begins = ends - sizes
    for n in range(int(sizes.max(initial=0))):
        some = sizes > n
        data[begins[some] + n] = (values[some] >> 7 * n) & 127
    data[ends - 1] |= 128
    return data, sizes


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data & 128)
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, begins)


# -- building a shard ----------------------------------------------------------------


class _Shard:
    """Collects documents until there is text enough."""

    def __init__(self) -> None:
        self.n_bytes = 0
        self._numbers: dict[bytes, int] = defaultdict()
        self._numbers.default_factory = self._numbers.__len__
        self._ids: list[int | None] = []
        self._found: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        self.n_bytes += len(text) + 64
        terms = terms_of(text)
        if terms:
            numbers = self._numbers
            self._ids.append(doc_id)
            self._found.append(np.array([numbers[t] for t in terms], np.int32))

    def row(self) -> pa.RecordBatch | None:
        if not self._ids:
            return None
        ids = np.array([NO_ID if i is None else i for i in self._ids], np.int64)
        missing = np.array([i is None for i in self._ids])
        order = np.lexsort((ids, missing))
        lengths = np.array([len(f) for f in self._found], np.int64)[order]
        postings = np.concatenate([self._found[n] for n in order], dtype=np.int64)
        self._found = []  # from here on they are postings
        postings <<= 32
        postings |= np.repeat(np.arange(len(order)), lengths)
        postings.sort()
        first = np.ones(len(postings), bool)
        np.not_equal(postings[1:], postings[:-1], out=first[1:])
        begins = np.flatnonzero(first)
        tfs = np.diff(begins, append=len(postings))
        postings = postings[begins]
        terms = pa.array([t.decode("utf-8", "replace") for t in self._numbers], pa.string())
        sizes = np.bincount(postings >> 32, minlength=len(terms))
        postings &= 0xFFFFFFFF
        encoded = _encoded(postings, tfs, sizes, lengths)
        offsets = np.frombuffer(terms.buffers()[1], np.int32, len(terms) + 1)
        row = {
            "doc_ids": ids[order].tobytes(), "terms": terms.buffers()[2].to_pybytes()[: offsets[-1]],
            "lengths": _bytes(lengths), "term_bytes": _bytes(np.diff(offsets)), "sizes": _bytes(sizes), **encoded,
        }
        columns = [pa.array([len(order)], pa.int64()), pa.array([int(lengths.sum())], pa.int64())]
        columns += [pa.array([row[name]], pa.binary()) for name in _BYTES]
        return pa.RecordBatch.from_arrays(columns, names=["docs", "words", *_BYTES])


def _bytes(values: np.ndarray) -> bytes:
    return packed(values)[0].tobytes()


def _encoded(docs: np.ndarray, tfs: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> dict[str, bytes]:
    """Blocks and their best pairs, from the documents and occurrences of one list after the other."""
    list_begins = np.cumsum(sizes) - sizes
    n_blocks = -(-sizes // BLOCK)
    number = np.arange(int(n_blocks.sum())) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    opens = np.append(np.repeat(list_begins, n_blocks) + BLOCK * number, len(docs))
    found: dict[str, list[bytes]] = defaultdict(list)
    begin = 0
    while begin < len(number):
        end = max(begin + 1, int(np.searchsorted(opens, opens[begin] + SLICE, side="right")) - 1)
        low, high = opens[begin], opens[end]
        doc, tf, bounds = docs[low:high], tfs[low:high], opens[begin : end + 1] - low
        # distances within a block; its first posting is told from the block before
        before = np.concatenate([[docs[low - 1]], doc[:-1]])
        before[bounds[:-1][number[begin:end] == 0]] = -1
        data, n_bytes = packed(np.column_stack([doc - before - 1, tf - 1]).ravel())
        block, pair_tfs, pair_lengths = _best_pairs(
            np.repeat(np.arange(end - begin), np.diff(bounds)), tf, lengths[doc]
        )
        found["data"].append(data.tobytes())
        found["lasts"].append(_bytes(doc[bounds[1:] - 1]))
        found["block_bytes"].append(_bytes(np.add.reduceat(n_bytes, 2 * bounds[:-1])))
        found["pairs"].append(_bytes(np.bincount(block, minlength=end - begin)))
        found["pair_tfs"].append(_bytes(pair_tfs))
        found["pair_lengths"].append(_bytes(pair_lengths))
        begin = end
    return {name: b"".join(parts) for name, parts in found.items()}


def _best_pairs(block: np.ndarray, tfs: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """(block, occurrences, length) of postings that none of the same block beats in both."""
    order = np.lexsort((-tfs, lengths, block))
    block, tfs, lengths = block[order], tfs[order], lengths[order]
    rank = (block << 32) | tfs
    so_far = np.maximum.accumulate(rank)
    best = np.ones(len(rank), bool)
    best[1:] = rank[1:] > so_far[:-1]  # a new block, or more occurrences than in shorter texts
    return block[best], tfs[best], lengths[best]


@contextmanager
def _rows_per_batch(spark: SparkSession, most: int) -> Iterator[None]:
    """For queries that run here. Spark's 10,000 texts or shards are more than a task should hold;
    a session that has fewer keeps them."""
    before = spark.conf.get(ROWS_PER_BATCH)
    spark.conf.set(ROWS_PER_BATCH, str(min(int(before), most) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(ROWS_PER_BATCH, before)


def build(
    docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The index of ``docs``, written at ``path``: a row per shard. Shards of further documents
    can be added to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for number, cell in zip(batch.column("id"), batch.column("text"), strict=True):
                shard.add(number.as_py(), cell.as_py())
                if shard.n_bytes >= shard_bytes:
                    row, shard = shard.row(), _Shard()
                    if row is not None:
                        yield row
                    row = None
                    give_back()
        if (row := shard.row()) is not None:
            yield row

    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"), text_or_empty(text).cast("binary").alias("text")
    )
    # rows are large: row groups of few of them, so that a task holds few shards
    rows = texts.mapInArrow(tidy(work), SHARD).write.option("parquet.block.size", SHARD_BYTES)
    with _rows_per_batch(docs.sparkSession, TEXTS_A_BATCH):
        rows.option("parquet.block.size.row.check.min", 1).parquet(path)
    return docs.sparkSession.read.schema(SHARD).parquet(path)


# -- scores ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Totals:
    """Documents with a term, and their terms with repeats."""

    docs: int
    words: int

    def impact(self, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        long_text = 100 - 90 + (90 * lengths * self.docs) // self.words
        return (1_000_000_000 * tfs) // (1000 * tfs + 8 * long_text)


def weight(df: Column, docs: int) -> Column:
    share = F.lit(2.0 * docs + 2) / (2 * df + 1)
    return F.floor(F.lit(1000.0) * F.log(share)).cast("long")


class _Lists:
    """The lists of one shard."""

    def __init__(self, row: dict[str, np.ndarray], totals: Totals, wanted: set[str]) -> None:
        self._row, self._totals = row, totals
        n_blocks = -(-row["sizes"] // BLOCK)
        ends = np.cumsum(n_blocks)
        held = pc.is_in(row["terms"], value_set=pa.array(wanted, pa.string())).to_numpy(zero_copy_only=False)
        self._at = {
            row["terms"][n].as_py(): (int(ends[n] - n_blocks[n]), int(ends[n])) for n in np.flatnonzero(held)
        }
        parts = totals.impact(row["pair_tfs"], row["pair_lengths"])
        pair_ends = row["pair_ends"]
        self._maxima = np.maximum.reduceat(parts, np.concatenate([[0], pair_ends[:-1]]))
        self._data = np.frombuffer(row["data"], np.uint8)
        self._decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.n_decoded = 0

    def has(self, term: str) -> bool:
        return term in self._at

    def maxima(self, term: str) -> np.ndarray:
        begin, end = self._at[term]
        return self._maxima[begin:end]

    def lasts(self, term: str) -> np.ndarray:
        begin, end = self._at[term]
        return self._row["lasts"][begin:end]

    def block(self, term: str, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what each adds to a score, before the term's weight."""
        begin, _ = self._at[term]
        at = begin + number
        if at not in self._decoded:
            first = int(self._row["ends"][at - 1]) if at else 0
            values = unpacked(self._data[first : int(self._row["ends"][at])])
            before = int(self._row["lasts"][at - 1]) if number else -1
            docs = np.cumsum(values[::2] + 1) + before
            self._decoded[at] = docs, self._totals.impact(values[1::2] + 1, self._row["lengths"][docs])
            self.n_decoded += 1
        return self._decoded[at]


class Best:
    """The best documents of an item so far: scores and ids, best first."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    @property
    def least(self) -> int:
        """What a document has to reach."""
        return int(self.scores[-1]) if len(self.scores) == self.most else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[order], ids[order]


def best_of_shard(lists: _Lists, doc_ids: np.ndarray, terms: list[tuple[str, int]], best: Best) -> None:
    """Block-Max MaxScore for one item."""
    held = [(t, w, w * int(lists.maxima(t).max())) for t, w in terms if w > 0 and lists.has(t)]
    held.sort(key=lambda x: (x[2], x[0]))
    below = np.cumsum([0, *(bound for _, _, bound in held)])  # of the lists before each
    if below[-1] < best.least:
        return
    for begin in range(0, len(doc_ids), STRETCH):
        end = min(begin + STRETCH, len(doc_ids))
        # lists before this one cannot make a best document by themselves
        essential = int(np.searchsorted(below[1:], best.least, side="left"))
        if essential == len(held):
            return
        scores = np.zeros(end - begin, np.int64)
        for term, w, _ in held[essential:]:
            lasts = lists.lasts(term)
            for number in range(
                int(np.searchsorted(lasts, begin)), min(int(np.searchsorted(lasts, end - 1)) + 1, len(lasts))
            ):
                docs, parts = lists.block(term, number)
                low, high = np.searchsorted(docs, (begin, end))
                scores[docs[low:high] - begin] += w * parts[low:high]
        found = np.flatnonzero(scores)
        scores = scores[found]
        found = found + begin
        for n in range(essential - 1, -1, -1):
            term, w, bound = held[n]
            keep = scores + below[n + 1] >= best.least
            found, scores = found[keep], scores[keep]
            if not len(found):
                break
            lasts = lists.lasts(term)
            number = np.searchsorted(lasts, found)
            inside = number < len(lasts)
            reach = np.zeros(len(found), np.int64)
            reach[inside] = w * lists.maxima(term)[number[inside]]
            keep = scores + reach + below[n] >= best.least
            found, scores, number = found[keep], scores[keep], number[keep]
            for at in np.unique(number[number < len(lasts)]):
                docs, parts = lists.block(term, int(at))
                mine = np.flatnonzero(number == at)
                place = np.minimum(np.searchsorted(docs, found[mine]), len(docs) - 1)
                hit = docs[place] == found[mine]
                scores[mine[hit]] += w * parts[place[hit]]
        keep = scores >= best.least
        if keep.any():
            best.add(scores[keep], doc_ids[found[keep]])


# -- searching ------------------------------------------------------------------------


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term), each once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (item, term.decode("utf-8", "replace"))
                for item, cell in zip(batch.column("item"), batch.column("text"), strict=True)
                for term in set(terms_of(cell.as_py()))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())],
                names=["item", "term"],
            )

    texts = items.select(
        F.col(item_id).cast("long").alias("item"), text_or_empty(text).cast("binary").alias("text")
    )
    return texts.mapInArrow(tidy(read), "item long, term string").distinct()


def _numbers(batch: pa.RecordBatch, name: str, n: int) -> np.ndarray:
    return unpacked(np.frombuffer(batch.column(name)[n].as_buffer(), np.uint8))


def _terms(batch: pa.RecordBatch, n: int) -> pa.StringArray:
    ends = np.cumsum(_numbers(batch, "term_bytes", n))
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
    return pa.StringArray.from_buffers(len(ends), offsets, batch.column("terms")[n].as_buffer())


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    for n in range(batch.num_rows):
        row = {name: _numbers(batch, name, n) for name in _PACKED if name != "term_bytes"}
        row["doc_ids"] = np.frombuffer(batch.column("doc_ids")[n].as_buffer(), np.int64)
        row["terms"] = _terms(batch, n)
        row["ends"], row["pair_ends"] = np.cumsum(row.pop("block_bytes")), np.cumsum(row.pop("pairs"))
        row["data"] = batch.column("data")[n].as_buffer()
        yield row


def _list_sizes(index: DataFrame) -> DataFrame:
    """(term, n): of each list of each shard."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                sizes = pa.array(_numbers(batch, "sizes", n), pa.int64())
                lists = pa.RecordBatch.from_arrays([_terms(batch, n), sizes], names=["term", "n"])
                for begin in range(0, lists.num_rows, TERMS_A_BATCH):
                    yield lists.slice(begin, TERMS_A_BATCH)

    return index.select("terms", "term_bytes", "sizes").mapInArrow(tidy(read), "term string, n long")


def _group_best(index: DataFrame, weighted: list, totals: Totals, most: int) -> DataFrame:
    """(item, doc_id, score): per task the best documents of each item of a group."""
    by_item: dict[int | None, list[tuple[str, int]]] = defaultdict(list)
    for item, term, w in weighted:
        by_item[item].append((term, w))
    plain = dict(by_item)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {t for terms in plain.values() for t, _ in terms}
        best = {item: Best(most) for item in plain}
        for batch in batches:
            for row in _rows(batch):
                lists = _Lists(row, totals, wanted)
                for item, terms in plain.items():
                    best_of_shard(lists, row["doc_ids"], terms, best[item])
        items = [item for item, b in best.items() for _ in b.ids]
        ids = np.concatenate([b.ids for b in best.values()] or [np.empty(0, np.int64)])
        scores = np.concatenate([b.scores for b in best.values()] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(ids, mask=ids == NO_ID), pa.array(scores)],
            names=["item", "doc_id", "score"],
        )

    return index.mapInArrow(tidy(work), "item long, doc_id long, score long")


def search(
    index: DataFrame, items: DataFrame, most: int = BEST, group_items: int = GROUP_ITEMS,
    item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's best documents. ``group_items`` bounds
    what a pass over the index looks for, so that the weights a task holds are bounded too."""
    docs, words = index.select(F.sum("docs"), F.sum("words")).first()
    totals = Totals(docs or 0, words or 0)
    wanted = stored(item_terms(items, item_id, text), "item-terms")
    dfs = _list_sizes(index).join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weights = dfs.select("term", weight(F.col("df"), totals.docs).alias("weight"))
    n_items = wanted.select("item").distinct().count()
    n_groups = max(1, -(-n_items // group_items))
    grouped = wanted.join(weights, "term").select(
        "item", "term", "weight", F.pmod(F.xxhash64("item"), F.lit(n_groups)).alias("g")
    )
    with _rows_per_batch(index.sparkSession, SHARDS_A_BATCH):
        weighted = stored(grouped, "item-weights")
    found = None
    for group in range(n_groups):
        terms = weighted.where(F.col("g") == group).select("item", "term", "weight")
        best = _group_best(index, [tuple(r) for r in terms.toLocalIterator()], totals, most)
        with _rows_per_batch(index.sparkSession, SHARDS_A_BATCH):
            part = stored(best, "item-best")
        found = part if found is None else found.unionByName(part)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= most)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
