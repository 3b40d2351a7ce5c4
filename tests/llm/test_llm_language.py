import itertools

import numpy as np
from llm_cases import LONG
from pyspark.sql import functions as F

from spanfold.llm import language


def test_viterbi_is_the_best_path():
    chance = np.random.default_rng(0)
    for _ in range(100):
        n_words = chance.integers(0, 6, 4)
        scores = chance.normal(size=(n_words.sum(), 3)).astype(np.float32) * 5
        first = np.cumsum(n_words) - n_words
        labels = language._viterbi(scores, first, n_words, 3.0)

        def value(path, at):
            steps = sum(a != b for a, b in itertools.pairwise(path))
            return sum(scores[at + i, x] for i, x in enumerate(path)) - 3.0 * steps

        for at, n in zip(first, n_words, strict=True):
            best = max(value(p, at) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(best - value(labels[at : at + n], at)) < 1e-3


def test_held_out_accuracy_and_spans(spark, small_docs):
    even = F.col("doc_id") % 2 == 0
    model = language.fit(small_docs.where(even))
    rows = language.identify(small_docs.where(~even), model).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    texts = {r.lang: r.text for r in small_docs.where("length(text) > 800").collect()}
    mixed = texts["en"][:300] + " " + texts["de"][:300] + " " + texts["en"][300:600]
    (found,) = language.identify(spark.createDataFrame([(mixed,)], ["text"]), model).collect()
    assert [s.lang for s in found.spans] == ["en", "de", "en"]
    assert abs(found.spans[1].start - 301) < 40 and abs(found.spans[1].end - 601) < 40


def test_block_size_changes_nothing(small_docs, monkeypatch):
    model = language.fit(small_docs)
    texts = [r.text for r in small_docs.limit(3).collect()] + ["x" * 5000 + " and the", ""]
    whole = language.label_texts(texts, model, 12.0)
    monkeypatch.setattr(language, "BLOCK", 97)
    assert [w[0] for w in whole] == [w[0] for w in language.label_texts(texts, model, 12.0)]


def test_edge_cases(edge_docs, no_docs):
    model = language.fit(edge_docs)
    assert model.languages == ("de", "en", "ru")
    rows = language.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[n].lang_pred for n in (1, 2, 3)} == {"und"} and by_id[2].score == 0
    assert by_id[4].lang_pred == "en" and by_id[4].spans[-1].end <= len(LONG)
    assert by_id[4].lang_pred == by_id[5].lang_pred
    assert language.identify(no_docs, model).count() == 0
    untaught = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(edge_docs, untaught).collect()} == {"und"}


def test_scripts_narrow_the_candidates(spark):
    rows = [("привет мир как дела " * 5, "ru"), ("hello world how are you " * 5, "en")]
    model = language.fit(spark.createDataFrame(rows, ["text", "lang"]))
    ask = spark.createDataFrame([("незнакомые слова",), ("中文",), ("other words",)], ["text"])
    found = [r.lang_pred for r in language.identify(ask, model).collect()]
    assert found[0] == "ru" and found[2] == "en" and found[1] in ("en", "ru")


def test_any_number_of_labels(spark, monkeypatch):
    """Many labels share buckets of n-grams and are told apart still; those beyond the bound are
    the rarest."""
    rows = []
    for n in range(150):
        word = "".join(chr(97 + int(c)) for c in np.random.default_rng(n).integers(0, 26, 9))
        rows += [(" ".join([word, word[::-1], word[2:]] * 4), f"l{n:03}")] * (2 if n < 140 else 1)
    docs = spark.createDataFrame(rows, ["text", "lang"])
    model = language.fit(docs)
    assert len(model.languages) == 150 and model.shared == 2
    assert model.weights.nbytes <= 3 * language.BUCKETS * language.WIDE * 4
    found = language.identify(docs.distinct(), model).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.9 * len(found)
    few = language.fit(docs, most_languages=140)
    assert few.languages == tuple(f"l{n:03}" for n in range(140))
