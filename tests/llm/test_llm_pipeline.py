"""The pipeline against its stages done plainly on collected rows."""

import corpus_pipeline
from llm_cases import DOCUMENTS, SMALL, prose
from test_llm_duplicates import clusters_of, grams

from spanfold.llm import language, mixing


def test_stages(spark, small_docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "secrets", "mixing", "pieces"
    ]
    kept = corpus_pipeline.identify_language(spark, small_docs, SMALL)
    assert kept.columns == small_docs.columns
    predicted = language.identify(small_docs, language.fit(small_docs.select("text", "lang")))
    sure = predicted.where("lang_pred <> 'und' AND score >= 0.5")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in sure.collect())
    assert kept.count() >= 0.98 * small_docs.count()  # prose stays

    distinct = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL)
    sets = {r.doc_id: grams(r.text) for r in kept.collect()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    stay = {n for n, root in clusters_of(sets, links).items() if n == root}
    assert {r.doc_id for r in distinct.collect()} == stay and distinct.count() == len(stay)

    redacted = corpus_pipeline.redact_secrets(spark, distinct, SMALL)
    assert redacted.count() == len(stay)
    assert redacted.where("n_chars <> length(text)").count() == 0

    mixed = corpus_pipeline.mix_sources(spark, redacted, SMALL)
    times = {r.doc_id: r.copies for r in mixing.mix(redacted).collect() if r.copies}
    found = [r.doc_id for r in mixed.collect()]
    assert {d: found.count(d) for d in set(found)} == times

    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(found)
    assert all(r.same_text and r.n_pieces == len(r.ids) for r in rows)


def test_edge_cases(spark, edge_docs, no_docs):
    for docs, count in ((edge_docs, None), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert count is None or docs.count() == count
        assert "same_text" in docs.columns and docs.where("text IS NULL OR text = ''").count() == 0


def test_texts_that_share_an_id(spark):
    """A near copy goes, the other text of its id stays; what stays does not depend on order."""
    other, near = prose(21, 80), prose(22, 80)
    rows = [
        (1, near, "en", "a", 1), (5, near + " end", "en", "a", 2), (5, other, "en", "a", 3),
        (7, prose(23, 70), "en", "a", 4), (7, prose(24, 70), "en", "a", 5), (7, prose(24, 70), "en", "a", 5),
        (None, other, "en", "a", 6), (9, other, "en", "b", 7),
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for frame in (docs, docs.orderBy("n_chars", ascending=False).repartition(3)):
        kept = corpus_pipeline.drop_near_duplicates(spark, frame, SMALL)
        assert kept.columns == docs.columns
        found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
        assert (1, near) in found and (5, near + " end") not in found
        assert sum(text == other for _, text in found) == 2  # one of 5 and 9, and that without an id
        assert [(i, t) for i, t in found if i == 7] == sorted((i, t) for i, t in {(r[0], r[1]) for r in rows} if i == 7)
