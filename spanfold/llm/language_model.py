"""Scoring texts with a probabilistic suffix tree over words, on top of a unigram score.

Texts are lower-cased (A-Z only) and read as words, then one end, which also stands before the
first word. Unigram (base) score: a token seen c times of N, among V distinct ones, has
probability (c + 1) / (N + V + 1).

The tree's symbols are all words. Contexts grow level by level: a run of words seen at least
``LEAST`` times is a candidate, and what follows it is counted over all training texts; a run
can be that frequent only if it is so without its first and without its last word. Followers
seen less often leave their mass to the context one word shorter, with whose distribution each
is smoothed: P(s | c) = n(c, s) / (n(c) + w) + spare(c) * P(s | shorter c), spare(c) being what
the listed followers leave. A candidate becomes a state if it diverges enough: the
log-likelihood it wins over the shorter context on its own counts must exceed half a log of N
per follower; suffixes of states are states. Every token is scored in its longest suffix state.

So the log-probability of a text is a sum over its runs of up to ``depth`` + 1 words: a word
brings its base probability, a run that ends with a state's listed follower the logarithm of
P(s | c) / (spare(c) P(s | shorter c)), and a run that is a state log spare(c) for the token
after it. All this is one written table (run, value), which grows with the corpus and stays
distributed; runs of at least ``COMMON_SHARE`` of all tokens (100,000 of each length at most, by
that very bound) are looked up where a text is read, the rarer ones are shuffled to their
values, so none is a hot key. Runs travel as 64-bit hashes (two of one hash would count as
one), those of a range of hashes and a piece of the texts in one row of a table; the ranges
are as many as the runs ask for, so that what meets in one task is bounded. A bitmap of fixed
size keeps most runs without a value out of the shuffle; where the corpus fills it, more of
them go on to the values, which decide in any case.

Defined cases: a null text is an empty one: one token, its end; without training texts the
scores are 0; an empty table has no scores. Texts of any length are read whole. Repeated rows are
rows of their own and score the same; nothing depends on order, so there are no ties; input
columns named like result columns are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.llm import linkage
from spanfold.llm.common import pieces, tidy
from spanfold.llm.minhash import placed_hashes, word_hashes, word_places
from spanfold.sources.scratch import release, stored

DEPTH = 2
LEAST = 2
WEIGHT = 8.0  # how many observations the shorter context's distribution stands for
COMMON_SHARE = 1e-5
CHUNK_BYTES = 4 << 20
ASK_BYTES = 2 << 20
CHUNK_TEXTS = 1 << 16  # so that 16 bits tell a text
RANGE = 1 << 19  # about how many runs, or values, make a range

# Fixed values of xxHash64.
_PRIMES = tuple(
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)


def _hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text last, and the number of tokens per text."""
    # bytes: lower() is A-Z only, words are cut at the six ASCII blanks
    laid = b"\n".join(t or b"" for t in texts).lower()
    starts, ends = word_places(laid)
    after = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts)))
    sizes = np.diff(np.searchsorted(starts, after), prepend=0) + 1
    hashes = np.full(len(starts) + len(texts), word_hashes([b""])[0])
    inside = np.ones(len(hashes), bool)
    inside[np.cumsum(sizes) - 1] = False
    hashes[inside] = placed_hashes(laid, starts, ends)
    return hashes.view(np.int64), sizes


def _parts(batches: Iterator[pa.RecordBatch], most_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the texts, with the hashes and sizes of them."""
    for batch in batches:
        for begin in range(0, batch.num_rows, CHUNK_TEXTS):
            for part in pieces(batch.slice(begin, CHUNK_TEXTS), "_text", most_bytes):
                yield part, *_hashes(part.column("_text").to_pylist())


def _ranges(count: int) -> int:
    return max(1, -(-count // RANGE))


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges a key is in."""
    high = keys.view(np.uint64) >> np.uint64(32)
    return ((high * np.uint64(ranges)) >> np.uint64(32)).astype(np.uint16 if ranges <= 1 << 16 else np.uint32)


def _packed(number: np.ndarray, ranges: int, *columns: np.ndarray) -> list[pa.Array]:
    """The ranges that occur, and what each holds of the columns; ``number`` ascends."""
    edges = np.searchsorted(number, np.arange(ranges + 1))
    some = np.flatnonzero(np.diff(edges))
    cut = [[c[edges[r] : edges[r + 1]].tobytes() for r in some] for c in columns]
    return [pa.array(some.astype(np.int32)), *(pa.array(c, pa.binary()) for c in cut)]


def _unpacked(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def run_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of a run, from those of the run without its last and without its first word. The
    same as ``xxhash64(context, suffix)`` in SQL."""
    one, two, three, four, five = _PRIMES
    key = np.full(len(context), 42, np.uint64)
    for values in (context, suffix):
        key = key + (five + np.uint64(8))
        key ^= _turned(values.view(np.uint64) * two, 31) * one
        key = _turned(key, 27) * one + four
        key = (key ^ (key >> np.uint64(33))) * two
        key = (key ^ (key >> np.uint64(29))) * three
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def runs(hashes: np.ndarray, sizes: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For contexts of one word, two, and so on, per token: the context's key, the key of the run
    without the context's first word, and whether the text goes back that far. Before a text's
    first word stands the end of the text before, which is an end like its own."""
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = hashes
    for length in range(1, depth + 1):
        context = np.roll(key, 1)
        yield context, key, place >= length - 1
        key = run_keys(context, key)


class Lookup:
    """Places of keys in a sorted table of distinct ones, as unsigned numbers. They are hashes, so
    their first bits tell about where one stands: in a cell that mostly holds one key or none."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys.view(np.uint64)
        if len(keys):
            self._least, span = self.keys[0], int(self.keys[-1] - self.keys[0])
            self._shift = np.uint64(max(0, span.bit_length() - (4 * len(keys)).bit_length()))
            self._last = span >> int(self._shift)
            cells = (self.keys - self._least) >> self._shift
            self._first = np.searchsorted(cells, np.arange(self._last + 2, dtype=np.uint64)).astype(np.int32)

    def found(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, or -1."""
        if not len(self.keys):
            return np.full(len(values), -1)
        values = values.view(np.uint64)
        cell = np.minimum((values - self._least) >> self._shift, np.uint64(self._last)).view(np.int64)
        first = self._first[cell]
        at = np.minimum(first, len(self.keys) - 1)
        there = self.keys[at] == values
        more = np.flatnonzero(~there & (self._first[cell + 1] - first > 1))
        at[more] = np.minimum(np.searchsorted(self.keys, values[more]), len(self.keys) - 1)
        there[more] = self.keys[at[more]] == values[more]
        return np.where(there, at, -1)


def _firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys as unsigned numbers, and where in it each of them comes first."""
    order = np.argsort(keys.view(np.uint64))
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]]))


def _bitmap(keys: DataFrame, marks: int = linkage.MARKS) -> np.ndarray:
    """Marks of the keys; they are hashes, so their last bits are their marks."""
    pages = linkage.bitmaps(keys.select(F.col("key").bitwiseAND(marks - 1).alias("mark")), "mark")
    bits = np.zeros(marks // 8, np.uint8)
    for page in pages.toLocalIterator():
        begin = page["_page"] * linkage.PAGE // 8
        bits[begin : begin + linkage.PAGE // 8] = np.frombuffer(page["_bits"], np.uint8)
    return bits


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mark = keys & (8 * len(bits) - 1)
    return (bits[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 > 0


@dataclass(frozen=True)
class Model:
    tokens: int
    distinct: int
    depth: int
    values: DataFrame  # key, n, known, gain (base), ratio: what a run adds to a score, in up to two rows
    common: Lookup  # keys of the common runs
    known: np.ndarray
    gain: np.ndarray
    ratio: np.ndarray
    marks: np.ndarray  # of runs of two words or more that have a value


def _as_bytes(docs: DataFrame, text: str, *rest: Column) -> DataFrame:
    return docs.select(*rest, F.col(text).cast("string").cast("binary").alias("_text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, hashes, _ in _parts(batches):
        found, n = np.unique(hashes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["key", "n"])


def _count_runs(texts: DataFrame, length: int, marks: np.ndarray | None, ranges: int) -> DataFrame:
    """(context, suffix, n) of runs of ``length`` words and a follower, seen ``LEAST`` times; where
    ``marks`` are given, only of those with context and suffix among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, sizes in _parts(batches):
            *_, (context, suffix, there) = runs(hashes, sizes, length)
            if marks is not None:
                there &= _has(marks, context) & _has(marks, suffix)
            context, suffix = context[there], suffix[there]
            keys = run_keys(context, suffix)
            order, first = _firsts(keys)
            n = np.diff(np.append(first, len(keys)))
            at = order[first]
            yield pa.RecordBatch.from_arrays(
                _packed(_range(keys[at], ranges), ranges, context[at], suffix[at], n.astype(np.uint32)),
                names=["range", "context", "suffix", "n"],
            )

    def add(counted: pa.Table) -> pa.Table:
        context, suffix = (_unpacked(counted, c, np.int64) for c in ("context", "suffix"))
        order, first = _firsts(run_keys(context, suffix))
        n = np.add.reduceat(_unpacked(counted, "n", np.uint32)[order].astype(np.int64), first)
        often = n >= LEAST
        at = order[first[often]]
        return pa.table({"context": context[at], "suffix": suffix[at], "n": n[often]})

    counted = texts.mapInArrow(tidy(count), "range int, context binary, suffix binary, n binary")
    return counted.groupBy("range").applyInArrow(add, "context long, suffix long, n long")


def _level(counted: DataFrame, shorter: DataFrame) -> DataFrame:
    """Probabilities of the counted followers. ``shorter`` has key, n and p, the probability of
    a run's last word after the others, for runs one word shorter."""
    contexts = counted.groupBy("context").agg(F.sum("n").alias("listed"), F.count("n").alias("kinds"))
    contexts = contexts.join(shorter.select(F.col("key").alias("context"), F.col("n").alias("size")), "context")
    contexts = contexts.withColumn("spare", (F.col("size") - F.col("listed") + WEIGHT) / (F.col("size") + WEIGHT))
    rows = counted.join(shorter.select(F.col("key").alias("suffix"), F.col("p").alias("before")), "suffix")
    return rows.join(contexts, "context").select(
        F.xxhash64("context", "suffix").alias("key"), "context", "suffix", "n", "size", "listed", "kinds", "spare",
        "before", (F.col("n") / (F.col("size") + WEIGHT) + F.col("spare") * F.col("before")).alias("p"),
    )


def _states(levels: list[DataFrame], tokens: int) -> list[DataFrame]:
    """(context, n, rest) per level: contexts that diverge, and the suffixes of longer ones."""
    states: list[DataFrame] = []
    needed = None
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        left = F.first("size") - F.first("listed")
        found = level.groupBy("context").agg(
            F.first("size").alias("n"), F.log10(F.first("spare")).alias("rest"),
            (F.sum(F.col("n") * F.log10(F.col("p") / F.col("before"))) + left * F.log10(F.first("spare"))).alias("won"),
            (0.5 * math.log10(tokens + 1) * (F.first("kinds") + 1)).alias("price"),
        )
        kept = F.col("won") > F.col("price")
        if needed is not None:
            found = found.join(needed.withColumn("needed", F.lit(True)), "context", "left")
            kept = kept | F.col("needed").isNotNull()
        here = stored(found.where(kept).select("context", "n", "rest"), "states")
        states.append(here)
        if number:
            of = levels[number - 1].select(F.col("key").alias("context"), F.col("suffix"))
            needed = here.join(of, "context").select(F.col("suffix").alias("context")).distinct()
    return states[::-1]


def fit(docs: DataFrame, text: str = "text", depth: int = DEPTH, common_share: float = COMMON_SHARE) -> Model:
    """Learn from all ``docs``: contexts of up to ``depth`` words."""
    texts = _as_bytes(docs, text)
    words = stored(
        texts.mapInArrow(tidy(_count_words), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words"
    )
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("n").alias("distinct")).first()
    tokens, distinct = sums["tokens"], sums["distinct"]
    shorter = words.withColumn("p", (F.col("n") + 1) / F.lit(float(tokens + distinct + 1)))
    marks = None
    levels: list[DataFrame] = []
    for length in range(1, depth + 1):
        counted = stored(_count_runs(texts, length, marks, _ranges(tokens)), "runs")
        levels.append(stored(_level(counted, shorter), "level"))
        release(counted)
        shorter = levels[-1].select("key", "n", "p")
        if length < depth:
            marks = _bitmap(shorter)
    states = _states(levels, tokens)
    none = F.lit(0.0)
    parts = [words.select("key", "n", F.lit(1).cast("long").alias("known"), F.log10(F.col("n") + 1.0).alias("gain"), none.alias("ratio"))]
    for level, known in zip(levels, states, strict=True):
        listed = level.join(known.select("context"), "context", "left_semi")
        added = F.log10(F.col("p") / (F.col("spare") * F.col("before")))
        for rows, key, value in ((known, "context", F.col("rest")), (listed, "key", added)):
            parts.append(
                rows.select(
                    F.col(key).alias("key"), "n", F.lit(0).cast("long").alias("known"), none.alias("gain"), value.alias("ratio")
                )
            )
    values = stored(reduce(DataFrame.unionByName, parts), "values")
    release(words, *levels, *states)
    # a run can be a state and a listed follower too
    often = values.where(F.col("n") >= max(1.0, tokens * common_share)).groupBy("key")
    common = often.agg(*(F.sum(c).alias(c) for c in _SUMS)).toPandas()
    keys = common["key"].to_numpy()
    order, _ = _firsts(keys)
    marks = _bitmap(values.where("known = 0"), linkage.MOST_MARKS)
    return Model(tokens, distinct, depth, values, Lookup(keys[order]), *(common[c].to_numpy()[order] for c in _SUMS), marks)


RESULT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
_SUMS = ("known", "gain", "ratio")
_ANSWER = ("chunk", "text", *_SUMS, "row", "n_tokens")
_ANSWER_TYPE = "chunk long, text binary, known binary, gain binary, ratio binary, row binary, n_tokens binary"
_KINDS = {"text": np.uint16, "known": np.int64, "gain": np.float64, "ratio": np.float64, "row": np.int64, "n_tokens": np.int64}


def _asked(rows: DataFrame, model: Model, ranges: int) -> DataFrame:
    """Per piece of the texts and range, the runs that are not common and which text each is of;
    and per piece, in any range, what its common ones add to each text."""
    common, marks, depth = model.common, model.marks, model.depth
    # the last one is for what is not common, found at -1
    known, gain, ratio = (np.append(v, 0) for v in (model.known, model.gain, model.ratio))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, (part, hashes, sizes) in enumerate(_parts(batches, ASK_BYTES)):
            text = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            at = common.found(hashes)
            added = ratio[at]
            left = at < 0
            found = [(hashes[left], text[left])]
            for context, suffix, there in runs(hashes, sizes, depth):
                run = run_keys(context, suffix)
                some = np.flatnonzero(there & _has(marks, run))
                place = common.found(run[some])
                added[some] += ratio[place]
                left = some[place < 0]
                found.append((run[left], text[left]))
            keys, text = (np.concatenate(c) for c in zip(*found, strict=True))
            of = _range(keys, ranges)
            order = np.argsort(of, kind="stable")
            asked = _packed(of[order], ranges, keys[order], text[order])
            first = np.cumsum(sizes) - sizes
            sums = (
                np.add.reduceat(v, first).astype(_KINDS[c]).tobytes()
                for c, v in zip(_SUMS, (known[at], gain[at], added), strict=True)
            )
            every = np.arange(len(sizes), dtype=np.uint16)
            own = (every.tobytes(), *sums, part.column("_row").to_numpy().tobytes(), sizes.astype(np.int64).tobytes())
            names = ["range", "key", *_ANSWER]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number % ranges], pa.int32()), pa.nulls(1, pa.binary()), pa.array([task + number]),
                    *(pa.array([c], pa.binary()) for c in own),
                ],
                names=names,
            )
            where, key, text = asked
            chunk = pa.array(np.full(len(where), task + number))
            none = pa.nulls(len(where), pa.binary())
            yield pa.RecordBatch.from_arrays([where, key, chunk, text, *[none] * (len(_ANSWER) - 2)], names=names)

    return rows.mapInArrow(tidy(ask), "range int, key binary, " + _ANSWER_TYPE)


def _answered(asked: pa.Table, values: pa.Table) -> pa.Table:
    """Per piece, what the runs it asked for add to its texts."""
    key = values.column("key").to_numpy()
    order, first = _firsts(key)
    lookup = Lookup(key[order[first]])
    sums = [np.add.reduceat(values.column(c).to_numpy()[order], first) if len(key) else np.zeros(0) for c in _SUMS]
    answers = []
    for number in range(asked.num_rows):
        row = {c: asked.column(c)[number] for c in ("key", *_ANSWER)}
        if not row["key"].is_valid:
            answers.append({c: row[c].as_py() for c in _ANSWER})
            continue
        at = lookup.found(np.frombuffer(row["key"].as_buffer(), np.int64))
        text = np.frombuffer(row["text"].as_buffer(), np.uint16)[at >= 0]
        at = at[at >= 0]
        some = np.flatnonzero(np.bincount(text))
        if len(some):
            answer = {"chunk": row["chunk"].as_py(), "text": some.astype(np.uint16).tobytes()}
            for c, v in zip(_SUMS, sums, strict=True):
                answer[c] = np.bincount(text, v[at])[some].astype(_KINDS[c]).tobytes()
            answers.append(answer)
    schema = pa.schema([("chunk", pa.int64()), *((c, pa.binary()) for c in _ANSWER[1:])])
    return pa.Table.from_pylist(answers, schema)


def _summed(answers: pa.Table) -> pa.Table:
    """The texts of a piece, with all sums."""
    own, rest = None, []
    for row in answers.to_pylist():
        found = {c: np.frombuffer(row[c], _KINDS[c]) for c in _KINDS if row[c] is not None}
        if "row" in found:
            own = found
        else:
            rest.append(found)
    total = {c: own[c].copy() for c in _SUMS}
    for found in rest:
        for c in _SUMS:
            total[c][found["text"]] += found[c]
    return pa.table({"_row": own["row"], "_tokens": own["n_tokens"], **{"_" + c: total[c] for c in _SUMS}})


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the text, with the scores of it."""
    rest = [c for c in docs.columns if c not in (*RESULT, text)]
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    row = F.xxhash64(key, F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_row")
    ranges = _ranges(model.values.count())
    high = F.shiftrightunsigned("key", 32)
    values = model.values.withColumn("range", F.shiftright(high * F.lit(ranges).cast("long"), 32).cast("int"))
    asked = _asked(_as_bytes(docs, text, row), model, ranges)
    answers = asked.groupBy("range").cogroup(values.select("range", "key", *_SUMS).groupBy("range")).applyInArrow(
        _answered, _ANSWER_TYPE
    )
    found = answers.groupBy("chunk").applyInArrow(_summed, "_row long, _tokens long, _known long, _gain double, _ratio double")
    # equal rows have one key and share its sums
    sums = stored(found.groupBy("_row").agg(*(F.max(c).alias(c) for c in ("_tokens", "_known", "_gain", "_ratio"))), "sums")
    whole = docs.select(*rest, row).join(sums, "_row")
    price = math.log10(model.tokens + 1 * (model.distinct + 1))
    base = F.col("_gain") - F.col("_tokens") * price
    return whole.select(
        *rest, F.col("_tokens").alias("n_tokens"), F.col("_known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("_ratio")).alias("score"),
    )
