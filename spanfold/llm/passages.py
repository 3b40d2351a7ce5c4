"""Substring de-duplication: passages that repeat across documents.

Paragraphs are pieces of text that a copy is cut into in the same way wherever it stands: a
paragraph ends with a line, with a word that ends a sentence, or after two words whose hash
says so (one in 32), for text without punctuation. Equal paragraphs of five or more words
are one item. Items are hashed into MinHash bands tuned for recall at the threshold,
paragraphs that meet are verified on their exact sets of five-word shingles, and clusters
are connected components (see ``linkage``). Sets of fewer than four shingles cannot be
similar without being equal, and take no part in the search for similar ones.

A paragraph is repeated if its cluster occurs in two documents or more. Neighbouring
repeated paragraphs of a document (shorter ones between them included) make a passage; those
of ``least_words`` or more are reported, all but the first occurrence of each as removed.

Whatever the cuts, every run of ``least_words`` words (a window) that occurs in two documents
is found too, and such windows are passages to the word. Anchors are the minima of the grams of
a third of that length, one in every window, whatever stands around it; only windows whose
anchor occurs in two documents are looked at, one by one where those of an anchor differ. Windows and paragraphs that touch
are one passage. Up to four words at either border that belong to another sentence or line
agree by chance more often than not and are left out, unless too few words would be left.

Result, a row per passage: id, ``start`` and ``end`` in code points, ``n_words``,
``component_id`` and ``kept_doc_id`` (smallest cluster of its paragraphs and the document of
its first occurrence) and ``removed``.

Defined cases: null, empty and short texts have no passages; rows with a null id are left
out, as nothing could be reported of them; rows that repeat id and text are one document;
texts are read whole; paragraphs are told apart by 64-bit hashes; input columns named like
result columns do not matter, as only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfold.llm import linkage
from spanfold.llm.common import pieces, text_or_empty, tidy
from spanfold.llm.minhash import MinHash, mixed, placed_hashes, shingles, word_places
from spanfold.sources.scratch import release, stored

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99
MOST_BANDS = 5
LEAST_SHINGLES = 4
LEAST_WORDS = 30
CUT_ONE_IN = 32
CHUNK_BYTES = 4 << 20

_PLACE = ("word", "n_words", "start", "size", "head", "head_size", "tail", "tail_size")
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?"]] = True


@dataclass(frozen=True)
class Words:
    """The words of a chunk of texts, one after the other."""

    starts: np.ndarray  # bytes
    ends: np.ndarray
    owner: np.ndarray  # which text
    number: np.ndarray  # place in that text
    hashes: np.ndarray
    closes: np.ndarray  # ends a sentence or a line
    inner: np.ndarray  # bytes that go on with a character
    offsets: np.ndarray  # of each text, bytes

    def _points(self, places: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code points in the text, which are bytes less those that go on with a character."""
        of = self.offsets[self.owner[at]]
        if not len(self.inner):
            return places - of
        first = np.searchsorted(self.inner, self.offsets)[self.owner[at]]
        return places - of - (np.searchsorted(self.inner, places) - first)

    def begin(self, at: np.ndarray) -> np.ndarray:
        return self._points(self.starts[at], at)

    def stop(self, at: np.ndarray) -> np.ndarray:
        return self._points(self.ends[at], at)


def laid_out(texts: list[bytes], least: int) -> Words | None:
    laid = b"\n".join(texts)
    starts, ends = word_places(laid)
    if len(starts) < least:
        return None
    data, hashes = np.frombuffer(laid, np.uint8), placed_hashes(laid, starts, ends)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    first = np.searchsorted(starts, offsets)  # of each text
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(starts))))
    number = np.arange(len(starts)) - first[owner]
    closes = _SENTENCE_END[data[ends - 1]]
    line_ends = np.searchsorted(starts, np.flatnonzero(data == 10)) - 1  # the word before
    closes[line_ends[(line_ends >= 0) & (line_ends < len(starts) - 1)]] = True
    return Words(starts, ends, owner, number, hashes, closes, np.flatnonzero(data.view(np.int8) < -64), offsets)


@dataclass(frozen=True)
class Paragraphs:
    """Paragraphs of ``WORDS`` or more words of a chunk of texts."""

    text: np.ndarray  # which text
    number: np.ndarray  # its place among the text's paragraphs of that length
    word: np.ndarray  # first word, counted in the text
    n_words: np.ndarray
    start: np.ndarray  # code points, in the text
    end: np.ndarray
    item: np.ndarray
    grams: np.ndarray  # shingle hashes of all, one after the other
    first_gram: np.ndarray


def cut(texts: list[bytes]) -> Paragraphs | None:
    words = laid_out(texts, WORDS)
    if words is None:
        return None
    hashes = words.hashes
    last = np.ones(len(hashes), bool)
    pair = mixed(hashes[1:] + np.uint64(3) * mixed(hashes[:-1]))
    last[1:-1] = pair[:-1] % np.uint64(CUT_ONE_IN) == 0
    last[:-1] &= words.number[:-1] > 0  # a pair is of one text, whatever stands before it
    last |= words.closes
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])
    long = stop - begin >= WORDS
    begin, stop = begin[long], stop[long]
    if not len(begin):
        return None
    grams = shingles(hashes, WORDS)
    count = stop - begin - WORDS + 1
    first = np.cumsum(count) - count
    at = np.repeat(begin - first, count) + np.arange(int(count.sum()))
    grams = grams[at]
    # all shingles in their order, so equal items are equal paragraphs
    order = np.arange(len(grams), dtype=np.uint64) - np.repeat(first, count).astype(np.uint64)
    item = mixed(np.add.reduceat(mixed(grams + order * np.uint64(0x632BE59BD9B4E019)), first))
    text = words.owner[begin]
    fresh = np.flatnonzero(np.diff(text, prepend=-1))
    number = np.arange(len(text)) - np.repeat(fresh, np.diff(np.append(fresh, len(text))))
    return Paragraphs(
        text, number, words.number[begin], stop - begin, words.begin(begin), words.stop(stop - 1),
        item.view(np.int64), grams, first,
    )


def _sliding(values: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """``of`` every ``size`` neighbours."""
    reach = 1
    while reach < size:
        step = min(reach, size - reach)
        values = of(values[:-step], values[step:])
        reach += step
    return values


@dataclass(frozen=True)
class Windows:
    """All runs of ``size`` words of a chunk that stay within a text, by their first word."""

    words: Words
    size: int
    gram: int  # words of an anchor
    grams: np.ndarray
    least: np.ndarray  # of each window, its least gram, which is its anchor
    first: np.ndarray  # groups of neighbouring windows of one anchor
    last: np.ndarray

    def items(self, at: np.ndarray) -> np.ndarray:
        found = np.zeros(len(at), np.uint64)
        for k in [*range(0, self.size - self.gram, self.gram), self.size - self.gram]:
            found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + self.grams[at + k] + np.uint64(1))
        return found.view(np.int64)

    def groups(self) -> np.ndarray:
        ends = self.items(self.first).view(np.uint64), self.items(self.last).view(np.uint64)
        return mixed(ends[0] * np.uint64(0x9E3779B97F4A7C15) + ends[1]).view(np.int64)

    def foreign(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words at the begin and at the end belong to another sentence or line."""
        head, tail = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for n in range(1, min(WORDS, self.size)):
            head[self.words.closes[at + n - 1]] = n
            tail[self.words.closes[after - 1 - n]] = n
        return head, tail


def windows(texts: list[bytes], size: int) -> Windows | None:
    words = laid_out(texts, size)
    if words is None:
        return None
    gram = max(1, size // 3)
    grams = shingles(words.hashes, gram)
    whole = words.owner[size - 1 :] == words.owner[: len(words.owner) - size + 1]
    if not whole.any():
        return None
    span = size - gram + 1
    least = np.where(whole, _sliding(grams, span, np.minimum), np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    at = np.flatnonzero(whole)
    fresh = (np.diff(at, prepend=-2) != 1) | (np.diff(least[at], prepend=np.uint64(0)) != 0)
    fresh |= np.diff(words.owner[at], prepend=-1) != 0
    begin = np.flatnonzero(fresh)
    # no longer than a window, so that the first and the last one tell what is between
    fresh |= (np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % size == 0
    begin = np.flatnonzero(fresh)
    return Windows(words, size, gram, grams, least.view(np.int64), at[begin], at[np.append(begin[1:], len(at)) - 1])


def _anchors(texts: DataFrame, size: int) -> DataFrame:
    """Anchors that stand in two documents, and whether their groups of windows differ."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", CHUNK_BYTES):
                found = windows([t or b"" for t in part.column("text").to_pylist()], size)
                if found is not None:
                    ids = part.column("id").take(pa.array(found.words.owner[found.first]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(found.least[found.first]), pa.array(found.groups())],
                        names=["id", "item", "windows"],
                    )

    found = texts.mapInArrow(tidy(read), "id long, item long, windows long").groupBy("item").agg(
        F.min("id").alias("least"), F.max("id").alias("most"),
        (F.min("windows") != F.max("windows")).alias("differ"),
    )
    return found.where("least < most").select("item", "differ")


def _windows(texts: DataFrame, size: int) -> DataFrame:
    """Windows whose anchor stands in two documents, and some others. Where the windows of an
    anchor are the same wherever it stands, a group of them is one row."""
    anchors = stored(_anchors(texts, size), "anchors")
    bits, differ = _marked(anchors), _marked(anchors.where("differ"))
    release(anchors)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", CHUNK_BYTES):
                found = windows([t or b"" for t in part.column("text").to_pylist()], size)
                if found is None:
                    continue
                anchor = found.least[found.first]
                # the mark of an anchor decides, so it is the same way in all documents
                single = _has(differ, anchor)
                group = np.flatnonzero(_has(bits, anchor) & ~single)
                first, last = found.first[single], found.last[single]
                count = last - first + 1
                each = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                items = np.concatenate([found.groups()[group], found.items(each)])
                at = np.concatenate([found.first[group], each])
                after = np.concatenate([found.last[group], each]) + size
                words, (head, tail) = found.words, found.foreign(at, after)
                begin, stop = words.begin(at), words.stop(after - 1)
                columns = [
                    words.number[at], after - at, begin, stop - begin, head, words.begin(at + head) - begin,
                    tail, stop - words.stop(after - 1 - tail),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(words.owner[at])), pa.array(items),
                        *(pa.array(c.astype(np.int32)) for c in columns),
                    ],
                    names=["id", "item", *_PLACE],
                )

    return texts.mapInArrow(tidy(read), "id long, item long, " + ", ".join(f"{c} int" for c in _PLACE))


def _same_windows(texts: DataFrame, size: int) -> DataFrame:
    """Windows that occur in two documents, as passages."""
    found = stored(_windows(texts, size), "windows")
    place = F.struct("id", "start")
    shared = found.groupBy("item").agg(F.min(place).alias("first"), F.max("id").alias("last_id")).where(
        F.col("first.id") < F.col("last_id")
    )
    begin, stop = F.col("start"), F.col("start") + F.col("size")
    return found.join(shared, "item").select(
        "id", (place != F.col("first")).alias("removed"), F.lit(True).alias("same"),
        *_borders(F.col("word"), F.col("word") + F.col("n_words"), begin, stop),
        *_borders(
            F.col("word") + F.col("head"), F.col("word") + F.col("n_words") - F.col("tail"),
            begin + F.col("head_size"), stop - F.col("tail_size"), "own_",
        ),
        F.struct(F.col("item").alias("component"), F.col("first.id").alias("id")).alias("of"),
    )


def _borders(word: Column, after: Column, start: Column, end: Column, prefix: str = "") -> list[Column]:
    names = ("word", "after", "start", "end")
    return [c.cast("long").alias(prefix + n) for c, n in zip((word, after, start, end), names, strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Paragraphs]]:
    for batch in batches:
        for part in pieces(batch, "text", CHUNK_BYTES):
            found = cut([t or b"" for t in part.column("text").to_pylist()])
            if found is not None:
                yield part, found


def _occurrences(texts: DataFrame, bands: linkage.Bands) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands.bands, bands.rows)
        for part, found in _chunks(batches):
            count = found.n_words - WORDS + 1
            keys = hasher.keys_of_parts(found.grams, found.first_gram)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(keys) + 1, dtype=np.int32) * bands.bands), pa.array(keys.ravel()),
                mask=pa.array(count < LEAST_SHINGLES),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(found.text)),
                    *(
                        pa.array(c.astype(np.int64))
                        for c in (found.number, found.word, found.n_words, found.start, found.end, found.item)
                    ),
                    lists,
                ],
                names=["id", "number", "word", "n_words", "start", "end", "item", "keys"],
            )

    return texts.mapInArrow(
        tidy(read),
        "id long, number long, word long, n_words long, start long, end long, item long, keys array<long>",
    )


def _marked(wanted: DataFrame) -> np.ndarray:
    """A bitmap of items; they are hashes, so their last bits are their marks."""
    pages = linkage.bitmaps(
        wanted.select(F.col("item").bitwiseAND(linkage.MARKS - 1).alias("mark")), "mark"
    )
    bits = np.zeros(linkage.MARKS // 8, np.uint8)
    for page in pages.toLocalIterator():
        begin = page["_page"] * linkage.PAGE // 8
        bits[begin : begin + linkage.PAGE // 8] = np.frombuffer(page["_bits"], np.uint8)
    return bits


def _has(bits: np.ndarray, items: np.ndarray) -> np.ndarray:
    mark = items & (linkage.MARKS - 1)
    return (bits[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 > 0


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(item, grams) of the wanted items and some others, possibly repeated."""
    bits = _marked(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _chunks(batches):
            items = np.flatnonzero(_has(bits, found.item) & (found.n_words - WORDS + 1 >= LEAST_SHINGLES))
            items = items[np.unique(found.item[items], return_index=True)[1]]
            sets = [
                np.unique(found.grams[b : b + n]).view(np.int64)
                for b, n in zip(
                    found.first_gram[items].tolist(), (found.n_words[items] - WORDS + 1).tolist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.item[items]), pa.array(sets, pa.list_(pa.int64()))], names=["item", "grams"]
            )

    return texts.mapInArrow(tidy(read), "item long, grams array<long>")


def repeated_passages(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, least_words: int = LEAST_WORDS,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    bands = linkage.choose_bands(threshold, recall, MOST_BANDS)
    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("text")
    ).where("id is not null and text is not null")
    found = stored(_occurrences(texts, bands), "paragraphs")
    # equal paragraphs, their first place, and whether they stand in two documents
    place = F.struct("id", "start")
    items = found.groupBy("item").agg(
        F.min(place).alias("first"), F.max("id").alias("last_id"), F.first("keys", True).alias("keys"),
        F.max("n_words").alias("size"),
    )
    items = stored(items, "items")
    entries = items.where("keys is not null").select("item", "size", F.posexplode("keys").alias("band", "key"))
    places = linkage.shared_buckets(entries)
    # read where an item stands first; it may come from other texts too, and one copy of its set goes on
    first = items.select("item", "first.id").join(places.select("item"), "item").select("id").distinct()
    first = stored(first, "first")
    sets = _sets(linkage.prefiltered(texts, "id", first), places.select("item")).groupBy("item").agg(F.first("grams").alias("grams"))
    placed = places.join(sets, "item").withColumn("weight", F.lit(1).cast("long"))
    pairs = linkage.verified(placed, bands.bands, ["grams"], linkage.jaccard_links(threshold))
    _, clusters = linkage.clustered(pairs)
    clusters = stored(clusters, "clusters")
    alike = items.select("item", "first", "last_id").join(clusters, "item").groupBy("component").agg(
        F.min("first").alias("first"), F.max("last_id").alias("last_id")
    )
    similar = clusters.join(alike, "component").select("item", "component", "first", "last_id")
    same = items.where(F.col("first.id") < F.col("last_id")).join(clusters, "item", "left_anti").select(
        "item", F.col("item").alias("component"), "first", "last_id"
    )
    repeated = stored(
        similar.where(F.col("first.id") < F.col("last_id")).unionByName(same).drop("last_id"), "repeated"
    )
    release(items, places, clusters, first)
    rows = linkage.prefiltered(found.drop("keys"), "item", repeated).join(repeated, "item").withColumn(
        "removed", F.struct("id", "start") != F.col("first")
    )
    in_order = Window.partitionBy("id", "removed").orderBy("number")
    # repeated rows of one id share their numbers, so a dense rank tells neighbours
    rows = rows.withColumn("run", F.col("number") - F.dense_rank().over(in_order))
    runs = rows.groupBy("id", "removed", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("word").alias("word"), F.max(F.col("word") + F.col("n_words")).alias("after"),
        F.min(F.struct("component", F.col("first.id").alias("id"))).alias("of"),
    )
    edges = [F.col(c) for c in ("word", "after", "start", "end")]
    runs = runs.select("id", "removed", F.lit(False).alias("same"), *_borders(*edges), *_borders(*edges, "own_"), "of")
    runs = runs.unionByName(_same_windows(texts, least_words))
    # what touches or overlaps is one passage
    in_order = Window.partitionBy("id", "removed").orderBy("word", "after")
    reach = F.max("after").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("apart", F.when(F.col("word") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    least, most = ("word", "start", "own_word", "own_start"), ("after", "end", "own_after", "own_end")
    passages = runs.groupBy("id", "removed", "run").agg(
        *(F.min(c).alias(c) for c in least), *(F.max(c).alias(c) for c in most),
        F.max("same").alias("same"), F.min("of").alias("of"),
    )
    own = F.col("own_after") - F.col("own_word") >= least_words

    def border(name: str) -> Column:
        return F.when(own, F.col("own_" + name)).otherwise(F.col(name))

    return passages.where(F.col("same") | (F.col("after") - F.col("word") >= least_words)).select(
        F.col("id").alias(doc_id), border("start").alias("start"), border("end").alias("end"),
        (border("after") - border("word")).alias("n_words"),
        F.col("of.component").alias("component_id"), F.col("of.id").alias("kept_doc_id"), "removed",
    )


def without_passages(docs: DataFrame, passages: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the removed passages cut out of their texts."""
    spans = passages.where("removed").groupBy(F.col(doc_id).alias("_id")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans")
    )
    rows = docs.join(spans, docs[doc_id] == spans["_id"], "left")
    whole = text_or_empty(text)
    kept = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("kept")),
        lambda a, s: F.struct(
            s["end"].alias("at"),
            F.concat(a["kept"], F.substring(whole, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))).alias("kept"),
        ),
        lambda a: F.concat(a["kept"], F.substring(whole, (a["at"] + 1).cast("int"), F.length(whole))),
    )
    return rows.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
