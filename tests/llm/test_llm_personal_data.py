import random
import re
import time

from llm_cases import prose
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from spanfold.llm import personal_data

FORMATS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in FORMATS for m in re.finditer(pattern, text or "") if passes(kind, m.group())
    ]


ODD = [
    "a@b.c_x@y.z a@b a@@b.c .@-.- é@x.y aé.b@x.y",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004 1.2.3 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 1234567890123456789012",
    "+1 (017) 555-7713 +12 +1234567890123456 +1-2-3-4-5-6-7-8. ++49 30 123456",
    "1 " * 300 + "4111111111111111 " * 70 + "x@y.zz " * 150,
    "",
]


def test_base_spans_against_regular_expressions(spark, small_docs):
    rows = [(n, t) for n, t in enumerate(ODD)] + [(1_000 + r.doc_id, r.text) for r in small_docs.collect()]
    docs = spark.createDataFrame(rows, ["doc_id", "text"])
    found = personal_data.find(docs, personal_data.Judge(None, {})).collect()
    texts = dict(rows)
    for row in found:
        assert [tuple(s) for s in row.base_spans] == plain(texts[row.doc_id])
        assert row.spans == row.base_spans


def telephone_docs(spark):
    rows = []
    for n in range(240):
        rows.append((n, f"{prose(n, 8)} please call +1 (9{n % 90 + 10}) 555-{1000 + n} {prose(n + 1, 5)}"))
        rows.append((1_000 + n, f"{prose(n, 6)} number +{n}{n}{n}x {prose(n + 2, 5)} +1.2.{n % 10}"))
    return spark.createDataFrame(rows, ["doc_id", "text"])


def test_trees_judge_other_proposals(spark):
    judge = personal_data.fit(telephone_docs(spark), precision=0.9)
    assert judge.model is not None and "phone" in judge.thresholds
    ask = spark.createDataFrame([(1, "please call 917-555-1234 today"), (2, "nothing here")], ["doc_id", "text"])
    first, second = sorted(personal_data.find(ask, judge).collect(), key=lambda r: r.doc_id)
    assert [(s.kind, s.start, s.end) for s in first.spans] == [("phone_like", 12, 24)]
    assert second.spans == []


def test_expression_equals_the_model(spark):
    docs = telephone_docs(spark)
    judge = personal_data.fit(docs)
    assert judge.model is not None
    features = docs.select(F.explode(personal_data._candidates(F.col("text"))).alias("c")).select("c.features")
    vectors = features.select(
        F.array(*[F.col(f"features.{f}") for f in personal_data.FEATURES]).alias("list"),
        judge.score(F.col("features")).alias("mine"),
    )
    scored = judge.model.transform(vectors.withColumn("vector", array_to_vector("list")))
    for row in scored.select("mine", F.element_at(vector_to_array("probability"), 2).alias("theirs")).collect():
        assert abs(row.mine - row.theirs) < 1e-9


def test_edge_cases(edge_docs, no_docs):
    judge = personal_data.fit(edge_docs)
    assert judge.model is None  # nothing to learn from
    found = personal_data.find(edge_docs, judge)
    assert found.count() == edge_docs.count()
    assert {len(r.spans) for r in found.collect()} == {0}
    assert personal_data.fit(no_docs).model is None
    assert personal_data.find(no_docs, judge).count() == 0


def test_thresholds_come_from_all_documents(spark):
    docs = telephone_docs(spark)
    small = personal_data.fit(docs, sample_docs=60)  # its half has fewer than 18 of a family
    assert small.model is not None and "phone" in small.thresholds
    copies = docs.unionByName(docs).unionByName(docs)
    judge = personal_data.fit(docs, precision=0.9)
    assert personal_data._calibrated(judge.model, copies.selectExpr("text AS _text"), 0.9) == (
        personal_data._calibrated(judge.model, docs.selectExpr("text AS _text"), 0.9)
    )


def best_first(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (not s[4], -s[2], s[0], s[3], s[1])):
        if s[4] or not any(s[0] < k[1] and k[0] < s[1] for k in kept):
            kept.append(s)
    return sorted(kept)


def test_picking_against_brute_force(spark):
    chance = random.Random(4)
    rows = []
    for n in range(60):
        found = []
        for _ in range(chance.choice([0, 1, 3, 40, 700])):
            start = chance.randrange(0, 4_000)
            base = chance.random() < 0.2
            found.append((start, start + chance.randrange(1, 25), 2.0 if base else round(chance.random(), 1), chance.choice("abc"), base))
        rows.append((n, list(dict.fromkeys(found))))
    # a chain in which each beats the one before: the first stays beside the third
    rows.append((60, [(0, 10, 0.5, "a", False), (8, 20, 0.6, "a", False), (18, 30, 0.7, "a", False)]))
    df = spark.createDataFrame(rows, f"id int, spans array<{personal_data.PICKED}>")
    for row in df.select("id", personal_data.pick(F.col("spans")).alias("kept")).collect():
        assert sorted(map(tuple, row.kept)) == best_first(rows[row.id][1]), row.id
    assert [s[0] for s in best_first(rows[60][1])] == [0, 18]


def test_very_many_proposals_in_one_text(spark):
    judge = personal_data.fit(telephone_docs(spark), precision=0.9)
    text = "call 917-555-1234 or +1 (917) 555-1234, 4111 1111 1111 1112, a@b.cc; " * 25_000
    docs = spark.createDataFrame([(1, text)], ["doc_id", "text"])
    began = time.monotonic()
    (row,) = personal_data.find(docs, judge).select(F.size("base_spans").alias("base"), F.size("spans").alias("all")).collect()
    assert time.monotonic() - began < 60
    assert row.base == 50_000 and row.all >= 75_000


def card_docs(spark):
    """Numbers of one format, told apart by what stands before them."""
    rows = []
    for n in range(300):
        body = f"{410000000000000 + n * 7919}"
        total = sum(d - 9 * (d > 9) for d in (int(c) * (2 - k % 2) for k, c in enumerate(body)))
        check = (10 - total % 10) % 10
        rows.append((2 * n, f"{prose(n, 6)} card {body}{check} {prose(n, 3)}"))
        rows.append((2 * n + 1, f"{prose(n, 6)} batch {body}{(check + 1 + n % 9) % 10} {prose(n, 3)}"))
    return spark.createDataFrame(rows, ["doc_id", "text"])


def test_context_is_learned(spark):
    judge = personal_data.fit(card_docs(spark))
    importance = dict(zip(personal_data.FEATURES, judge.model.featureImportances.toArray(), strict=True))
    assert importance["hint"] > 0.5 and importance["digits"] == 0 == importance["length"]
    ask = spark.createDataFrame(
        [(1, "my card 4111111111111112 (a slip)"), (2, "batch 4111111111111112")], ["doc_id", "text"]
    )
    first, second = sorted(personal_data.find(ask, judge).collect(), key=lambda r: r.doc_id)
    assert [s.kind for s in first.spans] == ["card_like"] and second.spans == [] == first.base_spans


def test_few_labels_count_with_those_of_all_families():
    many = [("card", 40, 97, 100), ("card", 10, 0, 100)]
    assert personal_data.thresholds(many, 0.95)["card"] == 0.8
    # none of its own: the rate of all; a few of its own move it
    assert personal_data.thresholds(many, 0.95)["phone"] == 0.8
    assert "phone" not in personal_data.thresholds([*many, ("phone", 40, 0, 3)], 0.95)
    assert personal_data.thresholds([], 0.95) == {}
