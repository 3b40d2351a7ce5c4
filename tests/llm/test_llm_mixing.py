import pytest
from pyspark.sql import functions as F

from spanfold.llm import mixing
from spanfold.llm.common import word_count


def test_taken_words_come_near_the_targets(spark, small_docs):
    many = spark.range(40).select(F.col("id").alias("copy")).crossJoin(small_docs)
    docs = many.withColumn("doc_id", F.col("copy") * 1_000 + F.col("doc_id")).drop("copy")
    mixed = mixing.mix(docs)
    rows = mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert all(abs(r.n - r.t) <= 0.02 * r.t for r in rows)
    assert mixed.where("taken > 3 * size").count() == 0
    assert sorted(map(tuple, mixed.select("doc_id", "taken").collect())) == sorted(
        map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "taken").collect())
    )


def test_water_level(spark):
    sizes = {"a": 10, "b": 1_000, "c": 50, "d": 5_000, None: 40}
    rows = [(n, " ".join(["w"] * size), s) for n, (s, size) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {r.source: r.target for r in mixing.mix(docs).collect()}
    # shared by weight; what is above three times a size is shared again
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    target, rest, open_ = {}, sum(sizes.values()), set(sizes)
    while True:
        level = rest / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ -= above
    target |= {s: level * weights[s] for s in open_}
    assert found == pytest.approx(target)


def test_words(spark):
    texts = ["", " ", "a", " a", "a ", "a\tb\x0bc\r\nd\x0c", " ", "a b  c"]
    frame = spark.createDataFrame([(t,) for t in texts], ["t"]).select("t", word_count(F.col("t")).alias("n"))
    assert {r.t: r.n for r in frame.collect()} == {t: len(t.encode().split()) for t in texts}


def test_edge_cases(edge_docs, no_docs):
    mixed = mixing.mix(edge_docs)
    rows = mixed.collect()
    assert len(rows) == edge_docs.count()
    assert {r.size for r in rows if r.text is None} == {0}
    assert {r.taken for r in rows if r.size == 0} == {0}
    copies = sum(r.copies for r in rows)
    assert mixing.emitted(mixed).count() == copies
    assert set(edge_docs.columns) - set(mixing.emitted(mixed).columns) == {"size", "target", "copies", "taken"}
    assert mixing.mix(no_docs).count() == 0
