"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spanfold.llm import lexical_search as search

ITEMS = "item_id long, text string, rank string, score string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, most=10):
    counts = [(i, Counter(split(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = defaultdict(set)
    for item, text in items:
        terms[item].update(split(text))
    found = []
    for item, wanted in terms.items():
        scores = []
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n) // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:most], 1)]
    return sorted(found, key=str)


def searched(spark, docs, items, tmp_path, shard_bytes=search.SHARD_BYTES, **options):
    index = search.build(docs, f"{tmp_path}/index", shard_bytes)
    return sorted((tuple(r) for r in search.search(index, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(3)
    words = [f"w{n}" for n in range(60)] + ["É", "é", "Ab", "aB", "\U0001d4d3x", "a_b", "1"]
    weights = [1 / (n + 1) for n in range(len(words))]
    docs = [(n, " ".join(chance.choices(words, weights, k=chance.randrange(0, 60)))) for n in range(700)]
    docs += [(n, "w1 w50 w51") for n in range(700, 760)]  # ties at the tenth place
    docs += [(5, "w50 again"), (None, "w50 w1"), (None, None), (-3, ""), (9, "x" * 9000)]
    items = [(n, " ".join(chance.choices(words, k=9))) for n in range(25)]
    items += [(30, "w50 w51"), (31, ""), (32, None), (33, "unknown"), (34, "w50"), (34, "w1 W1"), (None, "w2"), (35, "É-é")]
    return docs, items


@pytest.mark.parametrize("shard_bytes", [200, 5_000, search.SHARD_BYTES])
def test_against_all_scores(spark, rows, tmp_path, shard_bytes, monkeypatch):
    docs, items = rows
    frame = spark.createDataFrame([(*d, "old", 1) for d in docs], "doc_id long, text string, terms string, score int")
    wanted = spark.createDataFrame([(*i, "old", "old") for i in items], ITEMS)
    assert searched(spark, frame, wanted, tmp_path, shard_bytes) == ranked(docs, items)


def test_items_in_groups(spark, rows, tmp_path):
    docs, items = rows
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert searched(spark, frame, wanted, tmp_path, group_items=7, most=3) == ranked(docs, items, 3)


def test_edge_rows(spark, edge_docs, tmp_path):
    items = [(1, "the house"), (2, "x" * 50_000), (3, "one"), (4, "привет é"), (5, "wald more")]
    wanted = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert searched(spark, edge_docs, wanted, tmp_path) == ranked(docs, items)


def test_empty_tables(spark, edge_docs, no_docs, tmp_path):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert searched(spark, no_docs, items, tmp_path / "a") == []
    assert searched(spark, edge_docs, items.limit(0), tmp_path / "b") == []


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 300, 2**21, 2**40, 0, 5], np.int64)
    data, sizes = search.packed(values)
    assert (search.unpacked(data) == values).all() and len(data) == sizes.sum()


def test_blocks_are_left_packed(monkeypatch):
    """Once ten good documents are known, most blocks of frequent terms stay undecoded."""
    shard = search._Shard()
    for n in range(20_000):
        shard.add(n, b"common " * (1 + n % 3) + (b"rare" if n % 500 == 0 else b"other"))
    monkeypatch.setattr(search, "STRETCH", 20_000)
    (row,) = search._rows(shard.row())
    totals = search.Totals(20_000, int(row["lengths"].sum()))
    lists = search._Lists(row, totals, {"common", "rare"})
    best = search.Best(10)
    best.add(np.full(10, 6_000 * 30_000), np.arange(10))  # from another shard
    search.best_of_shard(lists, row["doc_ids"], [("rare", 6_000), ("common", 5)], best)
    n_blocks = len(lists.maxima("common")) + len(lists.maxima("rare"))
    assert lists.n_decoded < n_blocks / 2


def shard_of(texts):
    shard = search._Shard()
    for n, text in enumerate(texts):
        shard.add(n, text.encode())
    return shard.row()


@pytest.fixture(scope="module")
def rare_words():
    chance = random.Random(5)
    return [" ".join(f"{chance.randrange(9_000):x}" for _ in range(chance.randrange(400))) for _ in range(300)]


def test_a_shard_is_smaller_than_its_texts(rare_words):
    """An executor holds rows of the index several times over."""
    row = shard_of(rare_words)
    assert row.num_rows == 1
    assert row.nbytes < sum(len(t) for t in rare_words)


def test_shards_do_not_depend_on_how_they_are_encoded(rare_words, monkeypatch):
    texts = [*rare_words, *["often often then"] * 700]
    whole = shard_of(texts)
    for postings in (1, 150, 4_000):
        monkeypatch.setattr(search, "SLICE", postings)
        assert shard_of(texts).equals(whole)


def test_few_rows_are_held_at_once(spark, rows, tmp_path, monkeypatch):
    """Of texts and of shards, while an index is built and searched."""
    docs, items = rows
    folder = tmp_path / "seen"
    folder.mkdir()
    path = str(folder)

    def counted(work):
        def run(batches):
            def seen():
                for batch in batches:
                    what = "items" if "item" in batch.schema.names else "texts" if "text" in batch.schema.names else "shards"
                    with open(f"{path}/{what}-{batch.num_rows}", "w"):
                        pass
                    yield batch

            yield from work(seen())

        return run

    monkeypatch.setattr(search, "tidy", counted)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert searched(spark, frame, wanted, tmp_path, 2_000) == ranked(docs, items)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    sizes = defaultdict(set)
    for name in folder.iterdir():
        what, n = name.name.split("-")
        sizes[what].add(int(n))
    assert max(sizes["texts"]) <= 500
    assert sizes["shards"] == {1}
