"""N-gram Jaccard join: documents whose sets of word n-grams are at least 0.8 alike.

Documents with the same words are one class; its smallest id stands for it. Classes are
hashed into MinHash bands, whose number and rows are chosen for a target recall at the
threshold (20 x 5 for 0.9995 at 0.8), shuffled on band hashes, and pairs that meet are
verified on their full n-gram sets (see ``linkage``).

Result, one row per document: ``class_id``, ``n_links`` (documents that are at least that
similar, copies included), ``component_id`` (smallest id that links lead to, itself
included) and ``kept`` (it is its own component id).

Defined cases: words are runs of anything but white space, as written; a text of fewer than
five words is one n-gram; a text that is null or has no word links with nothing, nor does a
row with a null id (its class and component are null and it is kept). Ids identify texts:
rows that repeat id and text are copies of each other, and classes whose smallest id is
the same one are taken together. Texts of any length are read whole. Input columns named
like result columns do not matter, as only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from spanfold.llm import linkage
from spanfold.llm.common import tidy
from spanfold.llm.minhash import MinHash, shingles, word_hashes
from spanfold.sources.scratch import stored

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_BANDS = 20


def _signatures(docs: DataFrame, words: int, bands: linkage.Bands) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands.bands, bands.rows)
        for batch in batches:
            digests, sizes, keys = [], [], []
            for cell in batch.column("text"):
                split = (cell.as_py() or b"").split()
                grams = shingles(word_hashes(split), words)
                sizes.append(len(grams))
                digests.append(xxhash.xxh3_128_digest(b" ".join(split)) if split else None)
                keys.append(hasher.keys(grams) if split else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "digest", "size", "keys"],
            )

    return docs.mapInArrow(tidy(read), "id long, digest binary, size long, keys array<long>")


def _with_grams(rows: DataFrame, words: int) -> DataFrame:
    rest = [f for f in rows.schema.fields if f.name != "text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                np.unique(shingles(word_hashes((cell.as_py() or b"").split()), words)).view(np.int64)
                for cell in batch.column("text")
            ]
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sets, pa.list_(pa.int64()))], names=[*(f.name for f in rest), "grams"]
            )

    ordered = rows.select(*[f.name for f in rest], "text")
    schema = ordered.drop("text").schema.add("grams", ArrayType(LongType()))
    return ordered.mapInArrow(tidy(read), schema)


def jaccard_join(
    docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
    most_bands: int = MOST_BANDS, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    bands = linkage.choose_bands(threshold, recall, most_bands)
    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("text")
    )
    signed = stored(_signatures(texts, words, bands), "signatures")
    classes = signed.where("id is not null and digest is not null").groupBy("digest").agg(
        F.min("id").alias("item"), F.count(F.lit(1)).alias("weight"),
        F.first("size").alias("size"), F.first("keys").alias("keys"),
    )
    classes = stored(classes, "classes")
    entries = classes.select("item", "size", F.posexplode("keys").alias("band", "key"))
    places = linkage.shared_buckets(entries)
    meeting = stored(classes.select("item", "weight").join(places, "item"), "meeting")
    # few texts meet another: the rest is not shuffled
    texts = linkage.prefiltered(texts.withColumnRenamed("id", "item"), "item", meeting)
    found = linkage.verified(
        _with_grams(texts.join(meeting, "item"), words), bands.bands, ["grams"],
        linkage.jaccard_links(threshold),
    )
    links, clusters = linkage.clustered(found)
    per_class = classes.select("digest", "item", "weight").join(links, "item", "left").join(
        clusters, "item", "left"
    )
    of_class = per_class.select(
        "digest", F.col("item").alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "item").alias("component_id"),
    )
    known = signed.where("id is not null and digest is not null").select("id", "digest")
    silent = signed.where("id is null or digest is null")
    rows = known.join(of_class, "digest").select("id", "class_id", "n_links", "component_id").unionByName(
        silent.select(
            "id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"),
        )
    )
    return rows.select(
        F.col("id").alias(doc_id), "class_id", "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
