"""Near-duplicate vectors by randomly rotated binary codes.

A vector is scaled to length 1 and turned by several random rotations; the signs of the
turned coordinates are its binary code. With a code goes the inner product of the unit
vector and its code, the correction factor. For the code c of x and a whole vector y,
<c, y> / <c, x> is an unbiased estimate of the inner product of x and y over the choice of
rotations, and sqrt(1 - <c, x>^2) / <c, x> / sqrt(length - 1), times a confidence factor,
bounds its error. Only pairs whose estimate plus bound reaches the threshold are computed
exactly, in double precision, and only exact values decide.

Which pairs meet is decided by groups of code bits: two vectors at an angle a agree in a bit
with chance 1 - a / pi, so groups are chosen for a target recall at the threshold. Vectors
with equal components and label are one class before. What follows is in ``linkage``.

Result, one row per vector: ``n_links``, ``component_id``, ``kept``.

Defined cases: a vector that is null, empty, all zero, or holds a null or non-finite
component, or whose label or id is null, links with nothing and is its own component.
Vectors of another length than most have no cosine with them: only vectors of equal length
are compared. Ids identify vectors: rows that repeat id, label and vector are copies of
each other. Input columns named like result columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfold.llm import linkage
from spanfold.llm.minhash import mixed
from spanfold.sources.scratch import stored

THRESHOLD = 0.98
RECALL = 0.9999
MOST_BANDS = 32
CONFIDENCE = 4.0
SEED = 5


@cache
def rotations(size: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(coordinates, size): as many random orthogonal matrices as ``bits`` needs, stacked."""
    chance = np.random.default_rng([seed, size])
    blocks = []
    while sum(map(len, blocks)) < bits:
        q, r = np.linalg.qr(chance.standard_normal((size, size)))
        blocks.append(q * np.sign(np.diag(r)))
    return np.concatenate(blocks)


def coded(unit: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs (rows, coordinates) as +-1 and the correction factor of each row. Codes have
    length sqrt(rotations), as each rotation preserves lengths by itself."""
    turned = unit @ rotations(unit.shape[1], bits).T
    signs = np.where(turned >= 0, 1.0, -1.0)
    return signs, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def estimates(
    signs: np.ndarray, factor: np.ndarray, turned: np.ndarray, rotated: int
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded rows and whole (turned) ones, and their bounds.

    Everything is scaled so that a turned vector has length 1: the stacked rotations make
    it sqrt(rotated) long.
    """
    length = signs.shape[1]
    scale = math.sqrt(rotated)
    alike = factor / scale  # <code, vector>, both of length 1
    inner = signs @ turned.T / math.sqrt(length) / scale
    spread = np.sqrt(np.maximum(1 - alike**2, 0)) / alike / math.sqrt(length - 1)
    return inner / alike[:, None], CONFIDENCE * spread[:, None]


def _units(vectors: pa.Array) -> np.ndarray:
    table = np.stack([np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) for v in vectors])
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def _signatures(vectors: DataFrame, bands: linkage.Bands) -> DataFrame:
    """id, size, keys: one key per group of code bits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((batch.num_rows, bands.bands), np.int64)
            label = batch.column("label_hash").to_numpy()
            sizes = batch.column("size").to_numpy()
            column = batch.column("vector")
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                signs, _ = coded(_units(column.take(pa.array(rows))), bands.bands * bands.rows)
                bits = signs[:, : bands.bands * bands.rows] > 0
                found = mixed(label[rows].view(np.uint64) + np.uint64(size))[:, None].repeat(bands.bands, 1)
                for row in bits.reshape(len(rows), bands.bands, bands.rows).transpose(2, 0, 1):
                    found = mixed(found * np.uint64(3) + row.astype(np.uint64))
                keys[rows] = found.view(np.int64) | 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("weight"), batch.column("size"),
                 pa.array(list(keys), pa.list_(pa.int64())), column, batch.column("label")],
                names=["item", "weight", "size", "keys", "vector", "label"],
            )

    return vectors.mapInArrow(
        read, "item long, weight long, size long, keys array<long>, vector array<double>, label string"
    )


def cosine_links(threshold: float, bits: int):
    def verify(table: pa.Table, wanted: np.ndarray) -> np.ndarray:
        unit = _units(table.column("vector").combine_chunks())
        label = np.array(table.column("label").to_pylist(), object)
        wanted = wanted & (label[:, None] == label[None, :])
        signs, factor = coded(unit, bits)
        turning = rotations(unit.shape[1], bits)
        inner, bound = estimates(signs, factor, unit @ turning.T, len(turning) // unit.shape[1])
        likely = np.argwhere(wanted & (inner + bound >= threshold))
        links = np.zeros_like(wanted)
        for begin in range(0, len(likely), 1 << 16):
            i, j = likely[begin : begin + (1 << 16)].T
            links[i, j] = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
        return links

    return verify


def near_duplicates(
    rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, most_bands: int = MOST_BANDS,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    bands = linkage.choose_bands(1 - math.acos(threshold) / math.pi, recall, most_bands)
    vectors = stored(
        rows.select(
            F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
            F.col(label).cast("string").alias("label"),
        ),
        "vectors",
    )
    finite = F.forall(
        "vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    sound = F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    classes = vectors.where(sound).groupBy("label", "vector").agg(
        F.min("id").alias("item"), F.count(F.lit(1)).alias("weight")
    )
    classes = classes.select(
        "*", F.size("vector").cast("long").alias("size"), F.xxhash64("label").alias("label_hash")
    )
    signed = stored(_signatures(classes, bands), "signatures")
    places = linkage.shared_buckets(signed.select("item", "size", F.posexplode("keys").alias("band", "key")))
    placed = signed.drop("keys").join(places, "item")
    found = linkage.verified(
        placed, bands.bands, ["vector", "label"], cosine_links(threshold, bands.bands * bands.rows)
    )
    links, clusters = linkage.clustered(found)
    per_class = signed.select("label", "vector", "item", "weight").join(links, "item", "left").join(
        clusters, "item", "left"
    )
    of_class = per_class.select(
        "label", "vector",
        (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "item").alias("component_id"),
    )
    known = vectors.where(sound).join(of_class, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = vectors.where(~sound).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return known.unionByName(alone).select(
        F.col("id").alias(vec_id), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
