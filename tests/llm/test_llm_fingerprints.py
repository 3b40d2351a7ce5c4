import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from spanfold.llm import fingerprints


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def hashed(value, seed=42):
    data = struct.pack("<q", signed(value)) if isinstance(value, int) else value.encode()
    return xxhash.xxh64_intdigest(data, seed)


def winnowed(text, gram=5, window=4):
    """Hashes and positions, window by window."""
    runs = [hashed(t) for t in re.findall(r"[一-鿿]|[^\s一-鿿]{1,24}", text)]
    if not runs:
        return []
    if len(runs) < gram:
        seed = 42
        for r in runs:
            seed = hashed(r, seed)
        grams = [seed]
    else:
        def pair(xs, shift):
            return [hashed(b, hashed(a)) for a, b in zip(xs, xs[shift:], strict=False)]

        grams = pair(pair(pair(runs, 1), 2), 1)
    grams = [g & 0xFFFFFFFF for g in grams]
    chosen, size = [], min(window, len(grams))
    for begin in range(len(grams) - size + 1):
        least = min(grams[begin : begin + size])
        at = max(i for i in range(begin, begin + size) if grams[i] == least)
        if (least, at) not in chosen[-1:]:
            chosen.append((least, at))
    return chosen


def shown(chosen):
    return ",".join(f"{h}:{p}" for h, p in chosen)


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, found):
    ordered = sorted(rows)
    by_id = {r.doc_id: r for r in found}
    for n, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(n + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        row = by_id[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == shown(winnowed(text))
        assert row.edited_fingerprint == shown(winnowed(edited))
        assert abs(row.near_edited - likeness(winnowed(text), winnowed(edited))) < 1e-12
        assert abs(row.near_next - likeness(winnowed(text), winnowed(following))) < 1e-12


def test_against_plain_winnowing(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    check(rows, fingerprints.edited_texts(small_docs).collect())


def test_many_ranges_give_the_same(small_docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    check(rows, fingerprints.edited_texts(small_docs).collect())


def test_edge_cases(edge_docs, no_docs, spark):
    unique = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).where("doc_id <> -5")
    found = fingerprints.edited_texts(unique).collect()
    check([(r.doc_id, r.text) for r in unique.collect()], found)
    every = fingerprints.edited_texts(edge_docs).collect()
    assert len(every) == edge_docs.count()
    assert len({r.fingerprint for r in every if r.doc_id in (4, 5)}) == 1
    assert {r.fingerprint for r in every if r.doc_id in (1, 2, 3)} == {""}
    assert fingerprints.edited_texts(no_docs).count() == 0
    kept = fingerprints.fingerprint(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_shared_runs_are_found(spark):
    shared = " ".join(f"w{n}" for n in range(8))  # gram + window - 1 tokens
    texts = [(f"{'a ' * 30}{shared}{' b' * 30}",), (f"{'c ' * 17}{shared} d e f",)]
    rows = spark.createDataFrame(texts, ["text"]).select(fingerprints.winnowed(F.col("text")).alias("f"))
    one, other = ({p >> 31 for p in r.f} for r in rows.collect())
    assert one & other
