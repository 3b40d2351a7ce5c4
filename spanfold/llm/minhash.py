"""Words, their hashes, shingles and MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_word_hash = xxhash.xxh3_64_intdigest
_COLUMNS = 4_096


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hash, words), np.uint64, len(words))


# Fixed values of XXH3: parts of its secret, each the xor of two, and its factors.
_SHORT, _MIDDLE, _LOW, _HIGH = (
    np.uint64(v) for v in (0x87275A9B, 0xC73AB174C5ECD5A2, 0x6782737BEA4239B9, 0xAF56BC3B0996523A)
)
_P2, _P3, _RRMXMX, _AVALANCHE = (
    np.uint64(v) for v in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x9FB21C651E98DF25, 0x165667919E3779F9)
)
_HALF = np.uint64(0xFFFFFFFF)
_LONGEST = 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data.split()`` start and end."""
    blank = np.concatenate([[True], _BLANK[np.frombuffer(data, np.uint8)], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def _folded_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both halves of the 128-bit product, xor-ed."""
    shift = np.uint64(32)
    a_low, a_high, b_low, b_high = a & _HALF, a >> shift, b & _HALF, b >> shift
    low = a_low * b_low
    cross = (low >> shift) + ((a_high * b_low) & _HALF) + a_low * b_high
    return (a * b) ^ (((a_high * b_low) >> shift) + (cross >> shift) + a_high * b_high)


def placed_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``word_hashes`` of ``data[start:end]``, none of them empty, without a list of them: XXH3 of
    up to 16 bytes for all words at once."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
    sizes = ends - starts
    found = np.empty(len(starts), np.uint64)

    at = np.flatnonzero(sizes <= 3)
    begin, size = starts[at], sizes[at]
    one, two, three = (padded[p].astype(np.uint64) for p in (begin, begin + (size >> 1), begin + size - 1))
    h = one << np.uint64(16) | two << np.uint64(24) | three | size.astype(np.uint64) << np.uint64(8)
    h ^= _SHORT
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    found[at] = h ^ (h >> np.uint64(32))

    at = np.flatnonzero((sizes > 3) & (sizes <= 8))
    h = (four[ends[at] - 4].astype(np.uint64) + (four[starts[at]].astype(np.uint64) << np.uint64(32))) ^ _MIDDLE
    h = (h ^ _turned(h, 49) ^ _turned(h, 24)) * _RRMXMX
    h = (h ^ ((h >> np.uint64(35)) + sizes[at].astype(np.uint64))) * _RRMXMX
    found[at] = h ^ (h >> np.uint64(28))

    at = np.flatnonzero((sizes > 8) & (sizes <= _LONGEST))
    low, high = eight[starts[at]] ^ _LOW, eight[ends[at] - 8] ^ _HIGH
    h = sizes[at].astype(np.uint64) + low.byteswap() + high + _folded_product(low, high)
    h = (h ^ (h >> np.uint64(37))) * _AVALANCHE
    found[at] = h ^ (h >> np.uint64(32))

    at = np.flatnonzero(sizes > _LONGEST)
    found[at] = word_hashes([data[b:e] for b, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
    return found


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one run, an empty one none."""
    size = min(size, len(hashes))
    if size == 0:
        return hashes
    count = len(hashes) - size + 1
    found = np.zeros(count, np.uint64)
    for k in range(size):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count] + np.uint64(1))
    return found


class MinHash:
    """``bands`` keys of a set, each from ``rows`` minima."""

    def __init__(self, bands: int, rows: int, seed: int = 11) -> None:
        chance = np.random.default_rng(seed)
        shape = (bands * rows, 1)
        self._factor = chance.integers(1, 1 << 62, shape, np.uint64) * np.uint64(2) + np.uint64(1)
        self._offset = chance.integers(0, 1 << 63, shape, np.uint64)
        self._bands, self._rows = bands, rows

    def keys(self, grams: np.ndarray) -> np.ndarray:
        least = None
        for begin in range(0, len(grams), _COLUMNS):
            part = (grams[None, begin : begin + _COLUMNS] * self._factor + self._offset).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        found = np.zeros(self._bands, np.uint64)
        for row in mixed(least).reshape(self._bands, self._rows).T:
            found = mixed(found + row)
        return found.view(np.int64) | 1  # never 0, which stands for no bucket

    def keys_of_parts(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(parts, bands) keys of neighbouring parts of ``grams`` that begin at ``first``."""
        found = np.zeros((len(first), self._bands), np.uint64)
        for k in range(self._bands * self._rows):
            least = np.minimum.reduceat(grams * self._factor[k] + self._offset[k], first)
            band = k // self._rows
            found[:, band] = mixed(found[:, band] + mixed(least))
        return found.view(np.int64) | 1
