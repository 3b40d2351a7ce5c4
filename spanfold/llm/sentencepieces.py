"""SentencePiece encoding and decoding with a Viterbi search over shared prefixes.

A text is normalised and its spaces marked as the model file says, then cut into marked
words: no piece reaches over the place where a mark follows another character, so words
are independent. The distinct words of a chunk of documents are sorted, which lays them out
as a depth-first walk through their trie: going from one word to the next, the forward
states of the common prefix are kept and only the rest is computed.

A forward state is the best way to read a prefix: its score, its last piece and where that
begins. For a unigram model every piece may follow every other, and the sum of piece scores
counts. A BPE model's scores rank merges; the sum of them does not give its encoding. There
a piece may follow another only if merging the text of the two by rank ends in just these
two; every prefix then has one path, which is the BPE encoding of the prefix. Pieces of 1e9
below zero all rank alike, so words with a run of marks are merged directly.

Characters without a piece become byte pieces, or the unknown piece if the model has none.

Defined cases: a null text gives null ids, an empty text none; U+2581 in a text reads as a
space, as in the library; a text of any length is encoded whole; repeated rows are rows of
their own; an input column named like a result column is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from spanfold.llm.common import pieces, tidy

MARK = "▁"
CHUNK_BYTES = 2 << 20
# what a worker remembers from chunk to chunk
REMEMBERED_BYTES = 40 << 20
REMEMBERED_PAIRS = 300_000
_WORD_BYTES = 200  # of a short word and its ids, about
_LONG_WORD = 64
_UNIGRAM, _BPE = 1, 2
SHORT = (2, 1)


@dataclass(frozen=True)
class Model:
    """What encoding needs of a model file; its size is that of the vocabulary."""

    file: bytes
    kind: int
    ids: dict[str, int]
    scores: list[float]
    unknown: int
    byte_ids: list[int] | None
    as_bytes: list[bytes]
    dummy_prefix: bool

    def __post_init__(self) -> None:
        crossing = [p for p in self.ids if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing:
            raise ValueError(f"pieces that reach over a word's begin: {crossing[:3]}")


def load(path: str) -> Model:
    """Read a model file on the driver."""
    with open(path, "rb") as source:
        return parse(source.read())


def parse(data: bytes) -> Model:
    """Only unigram and BPE models have scores to search by."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(data)
    kind = proto.trainer_spec.model_type
    if kind not in (_UNIGRAM, _BPE):
        raise ValueError("neither a unigram nor a BPE model")
    normal, unknown, control, defined, byte = 1, 2, 3, 4, 6
    ids, byte_ids, as_bytes = {}, [0] * 256, []
    for number, piece in enumerate(proto.pieces):
        if piece.type == byte:
            code = int(piece.piece[3:5], 16)
            byte_ids[code] = number
            as_bytes.append(bytes([code]))
        elif piece.type in (normal, defined):
            ids[piece.piece] = number
            as_bytes.append(piece.piece.replace(MARK, " ").encode())
        else:
            as_bytes.append(b"" if piece.type == control else " ⁇ ".encode())
    unk = next(n for n, p in enumerate(proto.pieces) if p.type == unknown)
    return Model(
        data, kind, ids, [p.score for p in proto.pieces], unk,
        byte_ids if proto.trainer_spec.byte_fallback else None, as_bytes,
        proto.normalizer_spec.add_dummy_prefix,
    )


class WordEncoder:
    """Encodes sorted words, one trie path after the other."""

    def __init__(self, model: Model) -> None:
        self._model = model
        self._stable: dict[int, bool] = {}
        self._many = len(model.scores)
        self._names = {number: piece for piece, number in model.ids.items()}
        by_end: dict[str, set[int]] = {}
        for piece in model.ids:
            if len(piece) > 2:
                by_end.setdefault(piece[-3:], set()).add(len(piece))
        # lengths of the pieces that end in three given characters, longest first
        self._lengths = {e: (*sorted(n, reverse=True), *SHORT) for e, n in by_end.items()}
        self._unknown_score = min(model.scores) - 10.0

    def encode(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) for words in sorted order."""
        free, find, points = self._model.kind == _UNIGRAM, self._model.ids.get, self._model.scores
        lengths, pairs, many, unknown = self._lengths.get, self._stable.get, self._many, self._unknown_score
        before = ""
        # per prefix length: score, last piece (-1: a character without a piece), its begin
        scores, lasts, begins = [0.0], [-2], [0]
        for word in words:
            if not free and word.startswith(MARK * 2):
                yield word, self._ids(word, self._merged(word))
                continue
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            if shared < len(before):
                del scores[shared + 1 :], lasts[shared + 1 :], begins[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, last, begin = None, -1, end - 1
                for length in lengths(word[end - 3 : end], SHORT) if end > 2 else SHORT:
                    start = end - length
                    if start < 0 or (piece := find(word[start:end])) is None:
                        continue
                    if free:
                        score = scores[start] + points[piece]
                        if best is None or score > best:
                            best, last, begin = score, piece, start
                        continue
                    fits = pairs(lasts[start] * many + piece)
                    if fits or fits is None and self._fits(lasts[start], piece):
                        best, last, begin = scores[start] + points[piece], piece, start
                        break  # no other piece fits here
                scores.append(scores[begin] + unknown if best is None else best)
                lasts.append(last)
                begins.append(begin)
            before = word
            path, at, whole = [], len(word), True
            while at:
                path.append(lasts[at])
                whole = whole and lasts[at] >= 0
                at = begins[at]
            path.reverse()
            yield word, path if whole else self._with_bytes(word, path)

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging by rank ends in these two pieces; remembered, in bounded number."""
        if left < 0:
            whole = self._names[right]
            found = len(self._merged(whole)) == 1
        else:
            parts = [self._names[left], self._names[right]]
            found = self._merged("".join(parts)) == parts
        if len(self._stable) >= REMEMBERED_PAIRS:
            self._stable.clear()
        self._stable[left * self._many + right] = found
        return found

    def _merged(self, word: str) -> list[str]:
        """Merge neighbours, the best rank first and the leftmost of equals. Pairs wait in a
        heap; one whose parts have changed since is passed over. n log n for n characters."""
        find, scores = self._model.ids.get, self._model.scores
        parts: list[str] = list(word)
        following = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        pairs = [
            (-scores[piece], at, 2) for at in range(len(parts) - 1)
            if (piece := find(word[at : at + 2])) is not None
        ]
        heapify(pairs)
        while pairs:
            _, at, size = heappop(pairs)
            right = following[at]
            if right < 0 or not parts[at] or len(parts[at]) + len(parts[right]) != size:
                continue
            joined = parts[at] + parts[right]
            parts[at], parts[right] = joined, ""
            last = following[at] = following[right]
            following[right] = -1
            if last >= 0:
                before[last] = at
                if (piece := find(joined + parts[last])) is not None:
                    heappush(pairs, (-scores[piece], at, size + len(parts[last])))
            first = before[at]
            if first >= 0 and (piece := find(parts[first] + joined)) is not None:
                heappush(pairs, (-scores[piece], first, len(parts[first]) + size))
        return [part for part in parts if part]

    def _ids(self, word: str, parts: list[str]) -> list[int]:
        return self._with_bytes(word, [self._model.ids.get(part, -1) for part in parts])

    def _with_bytes(self, word: str, path: list[int]) -> list[int]:
        """Bytes, or the unknown piece once, in place of characters without a piece."""
        found, at, byte_ids = [], 0, self._model.byte_ids
        for piece in path:
            size = len(self._names[piece]) if piece >= 0 else 1
            if piece >= 0:
                found.append(piece)
            elif byte_ids is not None:
                found += [byte_ids[b] for b in word[at : at + 1].encode()]
            elif not found or found[-1] != self._model.unknown:
                found.append(self._model.unknown)
            at += size
        return found


class TextEncoder:
    """Encodes texts; remembers short words from chunk to chunk, in bounded size."""

    def __init__(self, model: Model) -> None:
        import sentencepiece

        self._normalize = sentencepiece.SentencePieceProcessor(model_proto=model.file).normalize
        self._words = WordEncoder(model)
        self._lines = "\n" not in model.ids and model.byte_ids is not None
        self._newline = array("i", [model.byte_ids[10]] if self._lines else []).tobytes()
        self._cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self._known: dict[str, bytes] = {}

    def _cut_up(self, text: str) -> list[list[str]]:
        """Marked words line by line. A line break without a piece stays apart by itself."""
        lines = []
        for line in text.split("\n") if self._lines else [text]:
            words = line.split(MARK)
            if "" in words[1:]:  # marks in a row belong to one word
                words = self._cut(line)
            else:
                first = words[0]
                words = [MARK + w for w in words]
                if first:
                    words[0] = first
                else:
                    del words[0]
            lines.append(words)
        return lines

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if t is None else self._cut_up(self._normalize(t)) for t in texts]
        words = set().union(*(line for lines in cut if lines for line in lines))
        new = words - self._known.keys()
        if (len(self._known) + len(new)) * _WORD_BYTES > REMEMBERED_BYTES:
            self._known.clear()
            new = words
        for word, ids in self._words.encode(sorted(new)):
            self._known[word] = array("i", ids).tobytes()
        get = self._known.__getitem__
        found = [
            None if lines is None
            else np.frombuffer(
                self._newline.join([b"".join(map(get, line)) for line in lines]), np.int32
            )
            for lines in cut
        ]
        for word in [w for w in new if len(w) > _LONG_WORD]:
            del self._known[word]
        return found


class TextDecoder:
    """The texts that ids stand for."""

    def __init__(self, model: Model) -> None:
        self._bytes = np.frombuffer(b"".join(model.as_bytes), np.uint8)
        self._sizes = np.fromiter(map(len, model.as_bytes), np.int64, len(model.as_bytes))
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._lead = b" " if model.dummy_prefix else b""

    def decode(self, ids: np.ndarray) -> str:
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self._starts[ids] - (ends - sizes), sizes) + np.arange(total)
        return self._bytes[at].tobytes().removeprefix(self._lead).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _ready(file: bytes) -> tuple[TextEncoder, TextDecoder]:
    """One pair per Python worker: what it remembers serves all its tasks."""
    model = parse(file)
    return TextEncoder(model), TextDecoder(model)


def _lists(found: list[np.ndarray | None]) -> pa.ListArray:
    sizes = [0 if ids is None else len(ids) for ids in found]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([ids for ids in found if ids is not None] or [np.empty(0, np.int32)])
    missing = pa.array([ids is None for ids in found])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)


def _with_columns(frame: DataFrame, added: list[StructField]) -> StructType:
    return StructType([*frame.schema.fields[:-1], *added])


def encode(
    docs: DataFrame, model: Model, text: str = "text", ids: str = "ids", same: str | None = None
) -> DataFrame:
    """``docs`` with the piece ids of the text; ``same`` names a column for whether decoding
    the ids gives the text again."""
    added = [ids] if same is None else [ids, same]
    rest = [c for c in docs.columns if c not in added]
    frame = docs.select(*rest, F.col(text).cast("string").alias("_in_text"))
    fields = [StructField(ids, ArrayType(IntegerType())), StructField(same or "", BooleanType())]
    file = model.file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _ready(file)
        for batch in batches:
            for part in pieces(batch, "_in_text", CHUNK_BYTES):
                texts = part.column("_in_text").to_pylist()
                found = encoder.encode(texts)
                columns = [*part.columns[:-1], _lists(found)]
                if same is not None:
                    columns.append(
                        pa.array(
                            [
                                None if t is None else decoder.decode(i) == t
                                for t, i in zip(texts, found, strict=True)
                            ],
                            pa.bool_(),
                        )
                    )
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, *added])

    return frame.mapInArrow(tidy(read), _with_columns(frame, fields[: len(added)]))


def decode(encoded: DataFrame, model: Model, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; an id outside the vocabulary fails."""
    rest = [c for c in encoded.columns if c != text]
    frame = encoded.select(*rest, F.col(ids).cast("array<int>").alias("_in_ids"))
    file = model.file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _ready(file)
        for batch in batches:
            texts = [
                decoder.decode(cell.values.to_numpy(zero_copy_only=False)) if cell.is_valid else None
                for cell in batch.column("_in_ids")
            ]
            made = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*rest, text])

    return frame.mapInArrow(tidy(read), _with_columns(frame, [StructField(text, StringType())]))
