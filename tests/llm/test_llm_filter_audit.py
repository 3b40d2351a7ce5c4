"""The filter audit against counting every order row by row."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import types as T

from spanfold.llm import filter_audit

LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
)


def failures(rows):
    """Per row the set of filters it fails."""
    found = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(
            o is not None and o < doc_id and (t or "") == text for o, t, *_ in rows
        ):
            fails.add("E")
        found.append(fails)
    return found


def counted(rows, labels):
    fails = failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    found = {}
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[3] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                    sum(x[1] == {f} for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
        for key in [k for k in found if k[0] == part]:
            found[key].append(shapley[key[1][key[2] - 1]])
    return found


def as_found(rows):
    return {
        (r.part, r.filter_order, r.step): [
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        ]
        for r in rows
    }


def plain(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 1, 0), (5, 0, 1), (5, 1, None), (6, None, 1), (10, 1, 1), (None, 1, 1), (999, 1, 1)]
    return spark.createDataFrame(rows, LABELS)


def test_edge_rows(spark, edge_docs, labels):
    found = filter_audit.audit(edge_docs, labels).collect()
    assert as_found(found) == counted(plain(edge_docs), [tuple(r) for r in labels.collect()])
    assert len(found) == len({r.part for r in found}) * 600


def test_empty_tables(spark, no_docs, edge_docs, labels):
    assert filter_audit.audit(no_docs, labels).count() == 0
    unlabelled = filter_audit.audit(edge_docs, labels.limit(0)).collect()
    assert all(r.good_lost == 0 == r.toxic_lost for r in unlabelled)
    assert as_found(unlabelled) == counted(plain(edge_docs), [])


def test_random_rows(spark, labels):
    chance = random.Random(5)
    texts = [
        " ".join(chance.choice(["a", "B", "c#", "word", f"w{n}", "Zz"]) for n in range(chance.randrange(0, 90)))
        for _ in range(25)
    ] + ["x y", "x  y", "X y", " x y", "\x1cx", None, ""]
    rows = [(n % 70, chance.choice(texts), None, chance.choice("abc") if n % 9 else None, 0) for n in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert as_found(filter_audit.audit(docs, labels).collect()) == counted(rows, [tuple(r) for r in labels.collect()])


def test_many_copies_meet_one_row_per_text(spark):
    """The right side of the semi-join has one row however many copies there are."""
    docs = spark.range(3000).selectExpr(
        "id", "'p' AS part", "if(id % 3 = 0, 'same text', cast(id AS string)) AS text"
    ).selectExpr("*", "xxhash64(text) AS hash")
    found = filter_audit.identical_to_smaller(docs, docs.select("id", "hash"))
    assert sorted(r.id for r in found.select("id").collect()) == list(range(3, 3000, 3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


def test_equal_hashes_are_no_copies(spark):
    docs = spark.createDataFrame([(1, "p", "one", 7), (2, "p", "two", 7), (3, "p", "one", 7)], "id long, part string, text string, hash long")
    found = filter_audit.identical_to_smaller(docs, docs.select("id", "hash"))
    assert [r.id for r in found.collect()] == [3]
