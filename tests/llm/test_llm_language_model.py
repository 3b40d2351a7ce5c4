import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfold.llm import language_model
from spanfold.llm.common import remainder

WEIGHT, LEAST = language_model.WEIGHT, language_model.LEAST


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


class Plain:
    """The same model, run by run in dictionaries."""

    def __init__(self, texts, depth):
        self.counts = collections.Counter(w for t in texts for w in t)
        self.total = sum(self.counts.values())
        self.followers = collections.defaultdict(collections.Counter)
        for text in texts:
            laid = (b"", *text)
            for at in range(1, len(laid)):
                for length in range(1, min(depth, at) + 1):
                    self.followers[laid[at - length : at]][laid[at]] += 1
        self.size = {c: sum(f.values()) for c, f in self.followers.items()}
        self.listed = {c: {s: n for s, n in f.items() if n >= LEAST} for c, f in self.followers.items()}
        self.listed = {c: f for c, f in self.listed.items() if f}
        self.states = set()
        for context, f in self.listed.items():
            spare = self.spare(context)
            won = sum(n * math.log10(self.p(context, s) / self.p(context[1:], s)) for s, n in f.items())
            won += (self.size[context] - sum(f.values())) * math.log10(spare)
            if won > 0.5 * math.log10(self.total + 1) * (len(f) + 1):
                self.states.update(context[k:] for k in range(len(context)))

    def spare(self, context):
        size = self.size[context]
        return (size - sum(self.listed[context].values()) + WEIGHT) / (size + WEIGHT)

    def p(self, context, symbol):
        if not context:
            return (self.counts[symbol] + 1) / (self.total + len(self.counts) + 1)
        before = self.p(context[1:], symbol)
        if context not in self.listed:
            return before
        return self.listed[context].get(symbol, 0) / (self.size[context] + WEIGHT) + self.spare(context) * before

    def longest(self, laid, at, depth):
        for length in range(min(depth, at), 0, -1):
            if laid[at - length : at] in self.states:
                return laid[at - length : at]
        return ()

    def score(self, text, depth):
        laid = (b"", *text)
        return sum(math.log10(self.p(self.longest(laid, at, depth), laid[at])) for at in range(1, len(laid)))


@pytest.mark.parametrize("depth, common_share", [(2, 1e-3), (3, 2.0)])
def test_scores_against_a_plain_model(spark, small_docs, depth, common_share):
    docs = small_docs.select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    model = language_model.fit(docs.where(~held_out), depth=depth, common_share=common_share)
    found = language_model.score(docs.withColumn("held_out", held_out), model).collect()
    texts = {r.doc_id: tokens(r.text) for r in docs.collect()}
    train = [t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    plain = Plain(train, depth)
    assert plain.states and any(len(s) == 2 for s in plain.states)
    for row in found:
        words = texts[row.doc_id]
        assert (row.n_tokens, row.train_tokens) == (len(words), plain.total)
        assert row.n_known == sum(plain.counts[w] > 0 for w in words)
        base = sum(math.log10(plain.p((), w)) for w in words)
        assert abs(row.base_score - base) < 1e-6 * abs(base)
        whole = plain.score(words, depth)
        assert abs(row.score - whole) < 1e-6 * abs(whole)
    unseen = [r for r in found if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_distributions_sum_to_one(small_docs):
    texts = [tokens(r.text) for r in small_docs.select("text").limit(40).collect()]
    plain = Plain(texts, 2)
    symbols = [*plain.counts, b"never seen"]
    for context in itertools.islice(plain.listed, 20):
        assert abs(sum(plain.p(context, s) for s in symbols) - 1) < 1e-9


def test_what_is_gathered_grows_with_the_corpus(spark):
    few = spark.createDataFrame([(f"a{i} b{i} c{i}",) for i in range(50) for _ in range(3)], ["text"])
    many = spark.createDataFrame([(f"a{i} b{i} c{i}",) for i in range(500) for _ in range(3)], ["text"])
    sizes = [language_model.fit(d).values.where("known = 0").count() for d in (few, many)]
    assert sizes[0] >= 2 * 50 and sizes[1] >= 2 * 500  # what follows a word here, whatever its share


def test_a_text_seen_twice_scores_apart(spark):
    picks = np.random.default_rng(5).integers(0, 2000, (60, 40))
    once = [" ".join(f"w{i}" for i in row) for row in picks]
    docs = spark.createDataFrame([(t,) for t in (*once, once[0])], ["text"])
    model = language_model.fit(docs)
    ask = spark.createDataFrame([(1, once[0]), (2, once[1])], ["doc_id", "text"])
    twice, single = sorted(language_model.score(ask, model).collect(), key=lambda r: r.doc_id)
    assert twice.score - twice.base_score > single.score - single.base_score + 10


def test_keys_are_those_of_sql(spark):
    values = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, (50, 2), np.int64)
    rows = spark.createDataFrame(values.tolist(), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("key")).collect()
    a, b, key = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    assert (language_model.run_keys(a, b) == key).all()


def test_ratios_are_those_of_the_longest_state(spark):
    docs = spark.createDataFrame([("a b " * 300,), ("c d " * 300,), ("b a c d " * 50,)], ["text"])
    model = language_model.fit(docs)
    ask = spark.createDataFrame([(1, "a b " * 10), (2, "a d b c " * 5)], ["doc_id", "text"])
    good, bad = sorted(language_model.score(ask, model).collect(), key=lambda r: r.doc_id)
    assert good.score > good.base_score + 1 and bad.score < bad.base_score


def test_edge_cases(edge_docs, no_docs):
    model = language_model.fit(edge_docs)
    found = language_model.score(edge_docs, model)
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    same = [r for r in rows if r.doc_id == 8]
    assert len(same) == 2 and same[0] == same[1] and same[0].n_known == same[0].n_tokens
    assert language_model.score(no_docs, model).count() == 0
    untaught = language_model.fit(no_docs)
    rows = language_model.score(edge_docs.where(F.col("doc_id") > 0), untaught).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in rows} == {(0, 0, 0.0)}


def test_lookup_finds_the_keys_and_no_others():
    chance = np.random.default_rng(7)
    crowded = np.arange(40, dtype=np.uint64) + np.uint64(1 << 63)
    for keys in (chance.integers(0, 1 << 64, 5000, np.uint64), crowded, crowded[:1], crowded[:0]):
        keys = np.unique(np.concatenate([keys, chance.integers(0, 1 << 64, len(keys) // 9, np.uint64)]))
        others = chance.integers(0, 1 << 64, 3000, np.uint64)
        ask = np.concatenate([keys[::-1], others, keys - np.uint64(1), keys + np.uint64(1)])
        place = {k: n for n, k in enumerate(keys.tolist())}
        assert language_model.Lookup(keys.view(np.int64)).found(ask.view(np.int64)).tolist() == [
            place.get(v, -1) for v in ask.tolist()
        ]


def test_pieces_and_ranges_do_not_show(spark, small_docs, monkeypatch):
    docs = small_docs.select("doc_id", "text").limit(120).localCheckpoint()

    def scores(docs):
        model = language_model.fit(docs, common_share=1e-2)
        return {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in language_model.score(docs, model).collect()}

    whole = scores(docs.coalesce(1))
    monkeypatch.setattr(language_model, "RANGE", 2_000)
    cut = scores(docs.repartition(5))
    assert len(whole) == len(cut) == 120
    assert all(cut[d] == pytest.approx(found, rel=1e-9) for d, found in whole.items())


def test_runs_travel_packed(spark, small_docs):
    texts = language_model._as_bytes(small_docs, "text").coalesce(1)
    plan = language_model._count_runs(texts, 1, None, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Aggregate" not in plan
