"""Registered queries of the operators: ``opN_<name>``, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.llm import (
    embeddings,
    filter_audit,
    fingerprints,
    language,
    language_model,
    lexical_search,
    mixing,
    near_duplicates,
    passages,
    personal_data,
    secret_scan,
    sentencepieces,
    warc,
)
from spanfold.llm.common import remainder, table, text_or_empty, word_count
from spanfold.llm.oracles import oracle_sql  # noqa: F401
from spanfold.sources.scratch import fresh_path, stored

Query = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 3) == 1
    model = language.fit(docs.where(~held_out).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans")
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_texts(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find(docs)
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secret_scan.BASE),
        F.sha2(secret_scan.joined(spans, secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


def piece_model() -> sentencepieces.Model:
    """The public 32k model of this machine; SPANFOLD_PIECE_MODEL names another file."""
    path = os.environ.get("SPANFOLD_PIECE_MODEL")
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.load(path)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to the same text again."""
    docs, model = table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model()
    encoded = sentencepieces.encode(docs, model, same="same_text")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "same_text")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 7) == 2
    model = language_model.fit(docs.where(~held_out).select("text"))
    return language_model.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find(docs, personal_data.fit(docs))
    spans = F.col("base_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, personal_data.BASE),
        F.sha2(secret_scan.joined(spans), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.jaccard_join(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = docs.select("doc_id", "source", word_count(text_or_empty("text")).alias("_size"))
    slim = stored(measured, "sizes")
    mixed = mixing.mix(slim.select("doc_id", "source"), measured=slim)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through files: archives of one gzip stream, normalised, read back by their index."""
    written = warc.write(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    records = warc.read(warc.normalise(written))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents"), fresh_path(spark, "lexical-index"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_language": op1_language,
        "op2_fingerprints": op2_fingerprints,
        "op3_secrets": op3_secrets,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_language_model": op5_language_model,
        "op6_personal_data": op6_personal_data,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_mixing": op8_mixing,
        "op9_embeddings": op9_embeddings,
        "op10_repeated_passages": op10_repeated_passages,
        "op11_filter_audit": op11_filter_audit,
        "op12_warc": op12_warc,
        "op13_lexical_search": op13_lexical_search,
    }
