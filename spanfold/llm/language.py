"""Language identification of whole texts and of the spans of a mixed text.

Training counts hashed character n-grams (one to three letters, the begin of a word included) per
language. Scripts are fixed ranges of code points; a language is a candidate for a word
only if it was seen to use the word's script. A word's score per language sums, over its
letters, the mean log probability of the n-grams that end there; the words of a text then go through a
Viterbi search in which changing the language costs ``switch``. Its path labels spans.

The prediction is the language that labels most letters, the score its share of them. Ties
go to the language that comes first in the model (by code point).

The model is fitted on a bounded sample: about ``docs_per_language`` labelled texts per
language, picked by a hash of the text, for the ``most_languages`` languages with the most labelled
texts. Its size is languages x buckets; beyond ``WIDE`` languages n-grams share buckets, twice as
many for twice the languages, so that it stays below 50 MB.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and no spans;
so is every text if nothing was learned. A text none of whose scripts was seen in training
takes the language of most training letters. Rows with a null language or text teach
nothing, nor do languages beyond ``most_languages``. An empty table gives an empty result. A text of
any length is read whole: letters are scored block by block, and only
word scores are kept. Repeated rows are rows of their own; input columns named like result
columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from spanfold.llm.common import pieces, tidy

UNKNOWN = "und"
MOST_LANGUAGES = 500
WIDE = 64
BITS = 16
BUCKETS = 1 << BITS
ORDERS = 3
CHUNK_BYTES = 4 << 20
BLOCK = 1 << 19

# Where scripts lie in Unicode, first and last code point.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS))
OTHER = len(SCRIPT_NAMES)

SPANS = ArrayType(
    StructType(
        [
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("lang", StringType()),
        ]
    )
)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is it a letter, its lower case if that is one character, its script."""
    top = 0x110000
    letter = np.fromiter((chr(c).isalpha() for c in range(top)), bool, top)
    lower = np.arange(top, dtype=np.uint32)
    for code in np.flatnonzero(letter):
        small = chr(code).lower()
        if len(small) == 1:
            lower[code] = ord(small)
    script = np.full(top, OTHER, np.int8)
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


@dataclass(frozen=True)
class Letters:
    """Letters of a block of text: bucket per order, script, and how they fall into words:
    the number of the first word, and of each word in the block its letters there."""

    buckets: list[np.ndarray]
    first: int
    sizes: np.ndarray
    script: np.ndarray


class Words:
    """Words (runs of letters) of a chunk of texts laid end to end, a space between them."""

    def __init__(self, texts: list[str]) -> None:
        letter, lower, _ = _tables()
        joined = "\n".join(texts).encode("utf-32-le", "surrogatepass")
        self.codes = np.frombuffer(joined, np.uint32)
        self.is_letter = letter[self.codes]
        # anything but a letter reads as one and the same mark
        self.lower = np.where(self.is_letter, lower[self.codes], np.uint32(1))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], self.is_letter.view(np.int8), [0]])))
        self.starts, self.ends = edges[::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.text_of_word = np.searchsorted(self.text_starts, self.starts, "right") - 1

    def blocks(self) -> Iterator[Letters]:
        """Letters block by block; n-grams look back over a block's begin."""
        _, _, script = _tables()
        for begin in range(0, len(self.codes), BLOCK):
            end = min(begin + BLOCK, len(self.codes))
            at = np.flatnonzero(self.is_letter[begin:end])
            if not len(at):
                continue
            back = min(begin, ORDERS - 1)
            codes, inside = self.lower[begin - back : end], self.is_letter[begin - back : end]
            grams = codes * np.uint32(0x9E3779B1)
            found, valid = [grams[back:][at] >> np.uint32(32 - BITS)], inside.copy()
            for order in range(1, ORDERS):
                # the characters before, as long as they are letters of the same word
                valid[order:] &= inside[:-order] if len(inside) > order else False
                valid[:order] = False
                before = np.ones_like(codes)
                before[order:] = np.where(valid[order:], codes[:-order], np.uint32(1))
                grams = (grams ^ (before + np.uint32(order))) * np.uint32(0x85EBCA6B)
                grams ^= grams >> np.uint32(15)
                found.append(grams[back:][at] >> np.uint32(32 - BITS))
            first = int(np.searchsorted(self.ends, begin, "right"))
            last = int(np.searchsorted(self.starts, end, "left"))
            sizes = np.minimum(self.ends[first:last], end) - np.maximum(self.starts[first:last], begin)
            yield Letters(found, first, sizes, script[self.codes[begin:end][at]])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    # (order, bucket, language), log probability
    weights: np.ndarray
    # (script, language), whether the language uses the script
    scripts: np.ndarray
    fallback: int
    # buckets of n-grams that count as one are 2 ** shared
    shared: int = 0


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang",
    docs_per_language: int = 2_000, smoothing: float = 0.5, least_share: float = 0.01,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Learn from labelled texts. ``docs_per_language`` bounds (in the mean) the sample,
    ``most_languages`` what can be predicted."""
    rows = labelled.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    sizes = {r["lang"]: r["n"] for r in by_size.limit(most_languages).collect()}
    languages = tuple(sorted(sizes))
    number = {name: k for k, name in enumerate(languages)}
    shared = (max(0, len(languages) - 1) // WIDE).bit_length()
    n = F.lit(None).cast("long")
    for name, size in sizes.items():
        n = F.when(F.col("lang") == name, size).otherwise(n)
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) * n < docs_per_language * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text", CHUNK_BYTES):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = np.array(part.column("text").to_pylist(), object)
                for name in dict.fromkeys(langs):
                    total = grams.setdefault(name, np.zeros(ORDERS * BUCKETS, np.int64))
                    seen = scripts.setdefault(name, np.zeros(OTHER + 1, np.int64))
                    for block in Words(list(texts[langs == name])).blocks():
                        for order in range(ORDERS):
                            total[order * BUCKETS : (order + 1) * BUCKETS] += np.bincount(
                                block.buckets[order], minlength=BUCKETS
                            )
                        seen += np.bincount(block.script, minlength=OTHER + 1)
        for name, total in grams.items():
            both = np.concatenate([total.reshape(-1, 1 << shared).sum(axis=1), scripts[name]])
            some = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), number[name])), pa.array(some), pa.array(both[some])],
                names=["lang", "slot", "n"],
            )

    # bounded by the size of the model, whatever the size of the corpus
    counts = (
        sample.mapInArrow(tidy(count), "lang long, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    )
    buckets = BUCKETS >> shared
    dense = np.zeros((ORDERS * buckets + OTHER + 1, len(languages)))
    dense[counts["slot"].to_numpy(), counts["lang"].to_numpy()] = counts["n"].to_numpy()
    grams = dense[: ORDERS * buckets].reshape(ORDERS, buckets, -1) + smoothing
    seen = dense[ORDERS * buckets :]
    letters = seen.sum(axis=0)
    return Model(
        languages,
        np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32),
        seen >= least_share * np.maximum(letters, 1),
        int(np.argmax(letters)) if languages else 0,
        shared,
    )


def _word_scores(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(scores per word and language, candidates); a word of an unseen script says nothing."""
    n, k = len(words.starts), len(model.languages)
    scores = np.zeros((n, k), np.float32)
    most = np.zeros((n, OTHER + 1), np.int32)
    for block in words.blocks():
        begins = np.cumsum(block.sizes) - block.sizes
        here = slice(block.first, block.first + len(begins))
        shared = np.uint32(model.shared)
        letter = model.weights[0][block.buckets[0] >> shared]
        for order in range(1, ORDERS):
            letter += model.weights[order][block.buckets[order] >> shared]
        scores[here] += np.add.reduceat(letter, begins, axis=0) / ORDERS
        for script in np.unique(block.script):
            most[here, script] += np.add.reduceat((block.script == script).astype(np.int32), begins)
    candidates = model.scripts[most.argmax(axis=1)]
    silent = ~candidates.any(axis=1)
    scores[~candidates] = -1e4
    scores[silent] = 0
    return scores, ~silent


def _viterbi(scores: np.ndarray, first_word: np.ndarray, n_words: np.ndarray, switch: float) -> np.ndarray:
    """Label of every word. Texts advance side by side, the longest ones last alone."""
    k = scores.shape[1]
    labels = np.zeros(len(scores), np.int8 if k < 128 else np.int32)
    stay = np.zeros((len(scores), k), bool)  # keeping the language is as good as any change
    leader = np.zeros(len(scores), labels.dtype)  # best language of the word before
    order = np.argsort(-n_words, kind="stable")
    first, count = first_word[order], n_words[order]
    alive = int(np.count_nonzero(count))
    if alive == 0:
        return labels
    state = scores[first[:alive]].copy()
    for step in range(1, int(count[0])):
        alive = int(np.searchsorted(-count, -step, "left"))
        state = state[:alive]
        at = first[:alive] + step
        best = state.argmax(axis=1)
        moved = state[np.arange(alive), best] - switch
        keeps = state >= moved[:, None]
        stay[at], leader[at] = keeps, best
        state = np.where(keeps, state, moved[:, None]) + scores[at]
        # finished texts leave from the end; their last label is set in the walk back
        ends = count[:alive] == step + 1
        labels[at[ends]] = state[ends].argmax(axis=1)
    only = count[: int(np.count_nonzero(count))] == 1
    labels[first[: len(only)][only]] = scores[first[: len(only)][only]].argmax(axis=1)
    for step in range(int(count[0]) - 1, 0, -1):
        alive = int(np.searchsorted(-count, -step, "left"))
        at = first[:alive] + step
        here = labels[at]
        labels[at - 1] = np.where(stay[at, here], here, leader[at])
    return labels


def label_texts(
    texts: list[str], model: Model, switch: float
) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, share of letters, spans) of each text."""
    nothing = (UNKNOWN, 0.0, [])
    words = Words(texts)
    if not len(words.starts) or not model.languages:
        return [nothing] * len(texts)
    scores, heard = _word_scores(words, model)
    n_words = np.bincount(words.text_of_word, minlength=len(texts))
    first_word = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    labels = _viterbi(scores, first_word, n_words, switch)
    sizes = words.ends - words.starts
    k = len(model.languages)
    letters = np.bincount(
        words.text_of_word * k + labels, sizes * heard, len(texts) * k
    ).reshape(-1, k)
    total = letters.sum(axis=1)
    changed = np.flatnonzero(
        np.diff(words.text_of_word, prepend=-1) | np.diff(labels.astype(np.int64), prepend=-1)
    )
    closed = np.append(changed[1:], len(labels)) - 1
    found: list[tuple[str, float, list]] = []
    for text in range(len(texts)):
        if not n_words[text]:
            found.append(nothing)
        elif not total[text]:
            found.append((model.languages[model.fallback], 0.0, []))
        else:
            top = int(letters[text].argmax())
            found.append((model.languages[top], float(letters[text, top] / total[text]), []))
    owners, offsets = words.text_of_word[changed], words.text_starts
    for start, end, owner in zip(changed.tolist(), closed.tolist(), owners.tolist(), strict=True):
        if total[owner]:
            base = int(offsets[owner])
            found[owner][2].append(
                (int(words.starts[start]) - base, int(words.ends[end]) - base,
                 model.languages[int(labels[start])])
            )
    return found


RESULT = ("lang_pred", "score", "spans")


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = 12.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans`` (start and end in code points)."""
    rest = [c for c in docs.columns if c not in RESULT]
    frame = docs.select(*rest, F.col(text).cast("string").alias("_text"))
    schema = StructType(
        [
            *frame.drop("_text").schema.fields,
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("spans", SPANS),
        ]
    )
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    # a word has a score for each language
    most_bytes = CHUNK_BYTES * 16 // max(16, len(model.languages))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text", most_bytes):
                texts = [t or "" for t in part.column("_text").to_pylist()]
                found = label_texts(texts, model, switch)
                columns = [
                    *part.columns[:-1],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array(
                        [[dict(zip(("start", "end", "lang"), s, strict=True)) for s in f[2]] for f in found],
                        pa.list_(span),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, *RESULT])

    return frame.mapInArrow(tidy(read), schema)
