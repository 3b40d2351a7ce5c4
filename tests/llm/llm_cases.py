"""Rows and helpers for the tests of the operators."""

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORDS = "the of and to in was that house river stone light der und die das nicht wald".split()


def prose(seed: int, n: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + chance.choice(["", "", "."]) for _ in range(n))


LONG = prose(1, 20_000)
CLASHING = (
    "size spans ids item key score label taken keys weight band digest word row n_tokens fingerprint "
    "base_spans lang_pred target copies grams id _range _copy"
).split()
# null and empty values, white space, a very long text, ties, repeated rows
EDGE_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, "a", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG + " more", "en", "b", len(LONG) + 5),
    (7, "x" * 50_000, "en", "b", 50_000),
    (8, prose(2, 60), "de", None, None),
    (8, prose(2, 60), "de", None, None),
    (None, prose(3, 60), "de", "c", 1),
    (None, None, None, None, None),
    (9, "one", "en", "a", 3),
    (10, "one", "en", "a", 3),
    (-5, "é \U0001d4d3 中文 \u0000 привет", "ru", "ü", 7),
]
