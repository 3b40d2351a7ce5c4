"""Preparing the documents of a corpus for training: five stages, each a written table.

``run(spark, sf_dir)`` applies the stages to ``documents``. Each stage is a function of
(spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of documents; the last adds what a trainer reads.

1. Language: texts without a letter, and texts in which no language labels half of the
   letters, go. The model learns from the labelled documents that came in.
2. Near duplicates: of each group of documents that are 0.8 alike in five-word shingles
   (directly or through others) the one with the smallest id stays; rows that repeat it
   go too. Different texts with one id are documents of their own.
3. Secrets: every span that a rule finds is replaced by a mark.
4. Mixing: documents are left out or repeated so that sources reach their weights.
5. Encoding: piece ids of every text.

Defined cases: a null or empty text goes in the first stage, as it has no letter; a null id
is like no other document and stays; texts of any length go through whole; rows that
repeat id and text are one after the second stage; of equally long documents the fourth takes
those first whose md5 of the id is smaller; an empty table gives an empty one; columns beside the
five of documents are left out at the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.llm import language, mixing, near_duplicates, secret_scan, sentencepieces
from spanfold.llm.queries import piece_model
from spanfold.sources.scratch import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_LANGUAGE_SHARE = 0.5
OTHER_TEXTS = 1 << 62
# A model and a rule set are no SQL, so the stages are tested against plain versions.
ORACLE_SQL = None

# Rows that cross to a Python worker at once, where the session leaves it at Spark's default.
# Documents are large rows: 10,000 of them are held several times over in an executor's memory.
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARK_DEFAULT, FEWER = "10000", "500"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_smaller_batches(spark: SparkSession) -> None:
    if spark.conf.get(ROWS_PER_BATCH) == SPARK_DEFAULT:
        spark.conf.set(ROWS_PER_BATCH, FEWER)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _with_smaller_batches(spark)
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.fit(docs.select("text", "lang")))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return found.where(sure).select(*COLUMNS)


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_id``: the id, but for rows that share one with another text. Of those the
    smallest text digest keeps the id; the others get one beyond all usual ids."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(digest).alias("_least"), F.max(digest).alias("_most")
    )
    shared = stored(ids.where("_least < _most").select("doc_id", "_least"), "shared-ids")
    other = F.xxhash64("doc_id", digest).bitwiseAND(OTHER_TEXTS - 1) + OTHER_TEXTS
    return docs.join(shared, "doc_id", "left").withColumn(
        "_id", F.when(F.col("_least") < digest, other).otherwise(F.col("doc_id").cast("long"))
    ).select(*COLUMNS, "_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _with_smaller_batches(spark)
    docs = _told_apart(docs.select(*COLUMNS))
    found = near_duplicates.jaccard_join(docs.select("_id", "text"), doc_id="_id")
    gone = found.where(~F.col("kept")).select("_id").distinct()
    rest = docs.join(gone, "_id", "left_anti")
    known = F.col("_id").isNotNull()
    return rest.where(known).dropDuplicates(["_id"]).unionByName(rest.where(~known)).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _with_smaller_batches(spark)
    redacted = secret_scan.redact(docs.select(*COLUMNS))
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _with_smaller_batches(spark)
    encoded = sentencepieces.encode(docs.select(*COLUMNS), piece_model(), same="same_text")
    return encoded.withColumn("n_pieces", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
