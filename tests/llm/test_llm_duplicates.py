"""Joins and clusters of similar documents, vectors and passages, against all pairs."""

import collections
import itertools
import math
import random

import numpy as np
import pytest
from llm_cases import DOCUMENTS, WORDS, prose
from pyspark.sql import functions as F

from spanfold.llm import embeddings, linkage, near_duplicates, passages


def clusters_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def grams(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def check_documents(rows, found):
    sets = {d: grams(t or "") for d, t in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0
    ]
    degree = collections.Counter(d for pair in links for d in pair)
    component = clusters_of(sets, links)
    for row in found:
        assert (row.n_links, row.component_id) == (degree[row.doc_id], component[row.doc_id]), row
        assert row.kept == (row.doc_id == component[row.doc_id])


def near_copies(seed, count, words=120):
    chance = random.Random(seed)
    base = prose(seed, words).split()
    for _ in range(count):
        copy = list(base)
        for _ in range(chance.randint(0, 4)):
            copy[chance.randrange(len(copy))] = f"w{chance.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("block", [linkage.BLOCK_ITEMS, 7])
def test_documents_against_all_pairs(spark, small_docs, monkeypatch, block):
    """A group of many near copies too, in one block and in many."""
    monkeypatch.setattr(linkage, "BLOCK_ITEMS", block)
    texts = [*near_copies(5, 60), *near_copies(6, 3), *[prose(7, 40)] * 20, "one two", "one two"]
    rows = [(r.doc_id, r.text) for r in small_docs.limit(80).collect()]
    rows += [(1_000 + n, t) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text"])
    check_documents(rows, near_duplicates.jaccard_join(docs).collect())


def test_document_edge_cases(edge_docs, no_docs):
    found = near_duplicates.jaccard_join(edge_docs).collect()
    assert len(found) == edge_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[4].n_links == 2 and by_id[6].component_id == 4  # a copy, and one with a word more
    assert by_id[9].kept and by_id[10].component_id == 9
    assert all(by_id[n].n_links == 0 and by_id[n].kept for n in (1, 2, 3))
    assert [r.n_links for r in found if r.doc_id == 8] == [1, 1]
    assert all(r.n_links == 0 and r.component_id is None for r in found if r.doc_id is None)
    assert near_duplicates.jaccard_join(no_docs).count() == 0


def test_bands_reach_their_recall():
    for agreement, recall, most in ((0.8, 0.9995, 20), (0.936, 0.9999, 32), (0.8, 0.99, 5)):
        chosen = linkage.choose_bands(agreement, recall, most)
        assert chosen.bands <= most and chosen.recall(agreement) >= recall
        assert linkage.Bands(most, chosen.rows + 1).recall(agreement) < recall


def test_components_of_chains_and_stars(spark):
    chain = [(n, n + 1) for n in range(60)]
    star = [(100, n) for n in range(101, 130)]
    edges = spark.createDataFrame(chain + star, ["item", "root"])
    found = {r.item: r.component for r in linkage.components(edges).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 130), 100)}


def test_prefilter_loses_nothing(spark, monkeypatch):
    rows, wanted = spark.range(1_000).toDF("key"), spark.range(0, 1_000, 7).toDF("key")
    for marks in (1 << 4, 1 << 16, 1 << 26):
        monkeypatch.setattr(linkage, "MARKS", marks)
        kept = linkage.prefiltered(rows, "key", wanted)
        assert kept.columns == ["key"]
        assert kept.join(wanted, "key").count() == wanted.count()
    assert kept.count() == wanted.count()
    monkeypatch.setattr(linkage, "MOST_MARKS", 16)  # too many to tell apart: all go on
    assert linkage.prefiltered(rows, "key", wanted).count() == 1_000


def test_estimates_are_unbiased_and_bounded():
    chance = np.random.default_rng(0)
    x = chance.normal(size=(200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + chance.normal(size=x.shape) * 0.02
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    turning = embeddings.rotations(64, 672)
    signs, factor = embeddings.coded(x, 672)
    inner, bound = embeddings.estimates(signs, factor, y @ turning.T, len(turning) // 64)
    error = inner - x @ y.T
    assert abs(error.mean()) < 1e-3 and (np.abs(error) <= bound).mean() > 0.999


def vector_rows():
    chance = np.random.default_rng(1)
    rows = []
    for n in range(40):
        base = chance.normal(size=16)
        for _ in range(3):
            spread = base + chance.normal(size=16) * chance.choice([0.01, 0.05, 0.1])
            rows.append((len(rows), spread.tolist(), int(n % 3)))
    copy = chance.normal(size=16).tolist()
    rows += [(500 + n, copy, 1) for n in range(30)] + [(600, copy, 2), (601, copy, None)]
    nan = float("nan")
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 16, 1), (703, [nan] * 16, 1), (704, [None] * 16, 1)]
    rows += [(705, [float("inf")] + copy[1:], 1), (706, copy[:8], 1), (None, copy, 1), (1, rows[1][1], rows[1][2])]
    return rows


@pytest.mark.parametrize("block", [linkage.BLOCK_ITEMS, 5])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(linkage, "BLOCK_ITEMS", block)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn(
        "keys", F.lit("old")
    )
    found = embeddings.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    sound = [
        (n, i, np.array(v, float), label) for n, (i, v, label) in enumerate(rows)
        if i is not None and v and label is not None and None not in v
        and all(map(math.isfinite, v)) and any(v)
    ]
    links, degree = [], collections.Counter()
    for (n, i, v, a), (m, j, w, b) in itertools.combinations(sound, 2):
        if a == b and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
            links.append((i, j))
            degree[n] += 1
            degree[m] += 1
    component = clusters_of({i for i, _, _ in rows if i is not None}, links)
    expected = sorted(
        (i, degree[n], component[i], i == component[i]) for n, (i, _, _) in enumerate(rows) if i is not None
    )
    assert sorted(tuple(r) for r in found if r.vec_id is not None) == expected
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, True)]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicates(none).count() == 0


def sentences(seed, n):
    chance = random.Random(seed)
    return " ".join(f"S{chance.randrange(10**6)} {prose(chance.random(), 9)} end." for _ in range(n))


def test_passages_inside_other_text(spark):
    shared = sentences(1, 6)  # over 60 words
    changed = shared.replace(" der ", " die ", 1)
    rows = [(n, f"{sentences(10 + n, 9)} {shared} {sentences(50 + n, 7)}") for n in range(6)]
    rows += [(20 + n, sentences(100 + n, 20)) for n in range(6)]
    rows += [(40, f"{sentences(200, 5)}\n{shared}"), (41, changed), (42, sentences(300, 3) + " " + sentences(300, 3))]
    docs = spark.createDataFrame(rows, ["doc_id", "text"])
    found = passages.repeated_passages(docs)
    texts = dict(rows)
    by_id = {r.doc_id: r for r in found.collect()}
    assert set(by_id) == {0, 1, 2, 3, 4, 5, 40, 41}
    for doc_id, row in by_id.items():
        assert row.removed == (doc_id != 0) and row.kept_doc_id == 0
        if doc_id != 41:
            assert texts[doc_id][row.start : row.end].strip() in shared
            assert row.n_words >= 0.7 * len(shared.split())
    left = {r.doc_id: r.text for r in passages.without_passages(docs, found).collect()}
    assert left[20] == texts[20] and left[0] == texts[0]
    assert len(left[3].split()) <= len(texts[3].split()) - 0.7 * len(shared.split())
    assert left[3].startswith(sentences(13, 9)[:40])


def test_cut_is_the_same_everywhere():
    piece = sentences(3, 8).encode()
    alone = passages.cut([piece])
    inside = passages.cut([b"x y z. " + piece + b" and so on", b"", piece])
    assert set(alone.item) <= set(inside.item)
    for text, start, end, n in zip(inside.text, inside.start, inside.end, inside.n_words, strict=True):
        body = [b"x y z. " + piece + b" and so on", b"", piece][text].decode()[start:end]
        assert len(body.split()) == n and body == body.strip()


def test_passage_edge_cases(spark, edge_docs, no_docs):
    found = passages.repeated_passages(edge_docs).collect()
    assert {r.doc_id for r in found} == {4, 5, 6}
    assert all(not r.removed for r in found if r.doc_id == 4)
    assert passages.repeated_passages(no_docs).count() == 0
    assert DOCUMENTS.fieldNames()[0] == "doc_id"


def test_one_copy_of_a_set_is_verified(spark, monkeypatch):
    rows = [(n, f"{sentences(n, 2)} {' '.join(WORDS[:12])} {n % 3}.") for n in range(40)]
    seen, verified = [], linkage.verified

    def watched(placed, *rest):
        seen.extend(r["item"] for r in placed.select("item").collect())
        return verified(placed, *rest)

    monkeypatch.setattr(linkage, "verified", watched)
    passages.repeated_passages(spark.createDataFrame(rows, ["doc_id", "text"]).repartition(8))
    assert len(seen) == len(set(seen)) > 0


def test_unpunctuated_passages_are_found_to_the_word(spark):
    def words(seed, n):
        chance = random.Random(seed)
        return " ".join(f"w{chance.randrange(10**7)}" for _ in range(n))

    rows, shared = [], {}
    for n, size in enumerate(range(30, 101, 2)):
        shared[n] = words(n, size)
        for copy in (0, 1):
            begin, end = words((n, copy, 1).__repr__(), 70 + n), words((n, copy, 2).__repr__(), 90)
            rows.append((2 * n + copy, f"é {begin} {shared[n]} {end}"))
    rows.append((1_000, words("short", 29)))
    rows.append((1_001, f"{words('other', 50)} {words('short', 29)}"))
    docs = spark.createDataFrame(rows, ["doc_id", "text"])
    found = passages.repeated_passages(docs).collect()
    texts = dict(rows)
    assert sorted(r.doc_id for r in found) == list(range(2 * len(shared)))
    exact = 0
    for r in found:
        passage, body = shared[r.doc_id // 2], texts[r.doc_id][r.start : r.end]
        # a paragraph at a border may be alike and not the same
        assert passage in body and r.n_words == len(body.split()) <= 1.25 * len(passage.split())
        assert r.removed == (r.doc_id % 2 == 1) and r.kept_doc_id == r.doc_id // 2 * 2
        exact += passage == body
    assert exact >= 0.9 * len(found)


def test_paragraphs_do_not_depend_on_the_texts_read_with_them():
    chance = random.Random(5)
    texts = [
        " ".join(f"w{chance.randrange(10**6)}" for _ in range(chance.randrange(5, 60))).encode() for _ in range(300)
    ]
    together = passages.cut(texts)
    for n, text in enumerate(texts):
        alone = passages.cut([text])
        mine = together.text == n
        for name in ("item", "word", "n_words", "start", "end"):
            expected = [] if alone is None else getattr(alone, name).tolist()
            assert getattr(together, name)[mine].tolist() == expected
