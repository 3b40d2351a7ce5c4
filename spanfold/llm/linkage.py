"""Similarity links between items that share a bucket: counted, verified, clustered.

Several operators hash items into buckets (one per band), so that similar items meet in at
least one. What follows is the same for all of them:

* Buckets of one member are dropped by counting members per bucket. Buckets with the same
  members are one bucket.
* A bucket is cut into blocks of bounded rows and bounded payload, and every pair of its
  blocks is a task's work by itself, so that a bucket of any size is spread and none is
  held in memory as a whole.
* A pair that shares several buckets is verified in the first of them only. So every pair
  counts once, without a list of pairs ever being written: a block pair yields one row
  per linked item, with the number of its links there and the least item of its cluster
  there. Output grows with the items, not with the pairs.
* Clusters are the connected components of these (item, least item) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.sources.scratch import release, stored

MARKS = 1 << 26
LEAST_MARKS, MOST_MARKS = 1 << 20, 1 << 28
PAGE_BITS = 15
PAGE = 1 << PAGE_BITS
BLOCK_ITEMS = 1_024
BLOCK_SIZE = 2_000_000

# (rows of a block pair, which pairs (i, j), i < j, to look at) -> which of them are linked
Verify = Callable[[pa.Table, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Bands:
    """``bands`` groups of ``rows`` hashes: the chance to share a bucket is
    1 - (1 - s ** rows) ** bands for two items whose hashes agree with chance s each."""

    bands: int
    rows: int

    def recall(self, agreement: float) -> float:
        return 1 - (1 - agreement**self.rows) ** self.bands


def choose_bands(agreement: float, recall: float, most_bands: int, most_rows: int = 64) -> Bands:
    """The most selective bands that still reach ``recall`` at ``agreement``: as many rows
    as possible, then as few bands as will do."""
    for rows in range(most_rows, 0, -1):
        for bands in range(1, most_bands + 1):
            found = Bands(bands, rows)
            if found.recall(agreement) >= recall:
                return found
    raise ValueError(f"{most_bands} bands do not reach a recall of {recall}")


def bitmaps(marks: DataFrame, column: str) -> DataFrame:
    """(page, bits): the marks that occur, 4 KB a page."""
    return marks.groupBy(F.shiftright(column, PAGE_BITS).alias("_page")).agg(
        F.bitmap_construct_agg(F.col(column).bitwiseAND(PAGE - 1)).alias("_bits")
    )


def prefiltered(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Most rows whose value in ``column`` is not among the ``wanted`` ones (a written table) fall
    away before a join shuffles them. What is broadcast is a bitmap with some 64 bits per wanted
    row, ``MOST_MARKS`` at most. Where that would be too full to tell rows apart, all rows go on
    to the join, which decides in any case."""
    n = wanted.count()
    if n > MOST_MARKS // 2:
        return rows
    marks = min(MOST_MARKS, max(LEAST_MARKS, 1 << (64 * n).bit_length()))

    def mark(name: str) -> Column:
        return F.xxhash64(name).bitwiseAND(marks - 1)

    pages = stored(bitmaps(wanted.select(mark(column).alias("_mark")), "_mark"), "marks")
    at = F.col("_mark").bitwiseAND(PAGE - 1)
    byte = F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(7).cast("int"))
    marked = rows.withColumn("_mark", mark(column)).withColumn("_page", F.shiftright("_mark", PAGE_BITS))
    found = marked.join(F.broadcast(pages), "_page").where(bit == 1)
    return found.select(*rows.columns)


def shared_buckets(entries: DataFrame) -> DataFrame:
    """(item, places), written: per item the buckets it shares with others, each (band, key, blocks).

    ``entries`` has a row per item and band: item, size (of its payload), band, key.
    """
    bucket = ["band", "key"]
    crowded = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*bucket)
    crowded = stored(crowded, "crowded")
    members = stored(prefiltered(entries, "key", crowded).join(crowded, bucket), "members")
    looks = members.groupBy(*bucket).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("sizes"),
        F.bit_xor(F.xxhash64("item")).alias("a"), F.bit_xor(F.xxhash64("item", F.lit(7))).alias("b"),
    )
    kept = looks.groupBy("n", "a", "b").agg(
        F.min(F.struct(*bucket)).alias("bucket"), F.max("sizes").alias("sizes")
    ).select(
        "bucket.*",
        F.greatest(F.ceil(F.col("n") / BLOCK_ITEMS), F.ceil(F.col("sizes") / BLOCK_SIZE)).alias("blocks"),
    )
    # at most one place per band
    places = members.join(kept, bucket).groupBy("item").agg(
        F.collect_list(F.struct("band", "key", "blocks")).alias("places")
    )
    places = stored(places, "places")
    release(crowded, members)
    return places


def verified(placed: DataFrame, n_bands: int, payload: Sequence[str], verify: Verify) -> DataFrame:
    """(item, n, root) per block pair and linked item. ``placed`` has item, weight, places
    and the payload columns that ``verify`` reads."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda band: F.coalesce(
            F.try_element_at(F.filter("places", lambda p: p["band"] == band), F.lit(1))["key"], F.lit(0)
        ),
    )
    rows = placed.select("item", "weight", keys.alias("keys"), F.explode("places").alias("place"), *payload)
    mine: Column = F.pmod(F.xxhash64("item", F.lit(3)), F.col("place.blocks"))
    rows = rows.select("*", mine.alias("mine")).select(
        F.col("place.band").alias("band"), F.col("place.key").alias("key"), "mine",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("place.blocks") - 1)).alias("other"),
        "item", "weight", "keys", *payload,
    )
    group = ["band", "key", "low", "high"]
    rows = rows.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    dealt = rows.drop("other").repartition(*group).sortWithinPartitions(*group)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, group):
            found = _linked(table, verify)
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in found], names=["item", "n", "root"]
                )

    return dealt.mapInArrow(work, "item long, n long, root long")


def _groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """Rows with equal group columns, which follow each other but may cross batches."""
    open_group: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in group])
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            here = tuple(values[begin])
            if open_group and here != last:
                yield pa.Table.from_batches(open_group)
                open_group = []
            open_group.append(batch.slice(begin, end - begin))
            last = here
    if open_group:
        yield pa.Table.from_batches(open_group)


def _linked(table: pa.Table, verify: Verify) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    if table.num_rows < 2:
        return None
    first = np.unique(table.column("item").to_numpy(), return_index=True)[1]
    if len(first) < table.num_rows:  # a repeated row
        table = table.take(pa.array(first))
    item = table.column("item").to_numpy()
    weight = table.column("weight").to_numpy()
    mine = table.column("mine").to_numpy()
    keys = np.array(table.column("keys").to_pylist(), np.int64)
    band, low, high = (int(table.column(c)[0].as_py()) for c in ("band", "low", "high"))
    wanted = np.triu(np.ones((len(item), len(item)), bool), 1)
    if low != high:  # within one block, another task looks
        wanted &= mine[:, None] != mine[None, :]
    for before in range(band):
        at = keys[:, before]
        wanted &= (at[:, None] != at[None, :]) | (at[:, None] == 0)
    if not wanted.any():
        return None
    links = verify(table, wanted)
    links |= links.T
    some = links.any(axis=1)
    if not some.any():
        return None
    links, item, weight = links[some][:, some], item[some], weight[some]
    root = item.copy()
    while True:
        least = np.minimum(root, np.where(links, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == root).all():
            break
        root = least
    return item, links @ weight, root


def jaccard_links(threshold: float, column: str = "grams") -> Verify:
    """Links by the Jaccard similarity of whole sets, kept as sorted distinct numbers."""

    def verify(table: pa.Table, wanted: np.ndarray) -> np.ndarray:
        sets = table.column(column).combine_chunks()
        offsets = sets.offsets.to_numpy()
        values = sets.values.to_numpy()
        values = np.unique(values[offsets[0] : offsets[-1]], return_inverse=True)[1].ravel()
        begins, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
        marked = np.zeros(int(values.max(initial=0)) + 1, bool)
        links = np.zeros_like(wanted)
        for i in np.flatnonzero(wanted.any(axis=1)):
            mine = values[begins[i] : begins[i] + sizes[i]]
            j = np.flatnonzero(wanted[i])
            # a set that is too small or too large cannot reach the threshold
            j = j[(sizes[j] >= threshold * sizes[i]) & (sizes[i] >= threshold * sizes[j])]
            if not len(j) or not sizes[i]:
                continue
            marked[mine] = True
            if len(j) > 16 and len(j) * 2 > len(sizes):
                hits = np.concatenate([[0], np.cumsum(marked[values])])
                common = hits[begins[j] + sizes[j]] - hits[begins[j]]
            else:
                common = np.array([np.count_nonzero(marked[values[begins[x] : begins[x] + sizes[x]]]) for x in j])
            marked[mine] = False
            # in whole numbers where possible: common / union >= threshold
            links[i, j] = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
        return links

    return verify


def components(edges: DataFrame) -> DataFrame:
    """(item, component): the least item that can be reached, for items with an edge.

    ``edges`` has item and root. Rounds of hooking every item and its neighbours on the
    least one of them (first the larger neighbours, then the smaller ones) end in stars.
    Each round is a written table, so no plan and no lineage grows with the rounds.
    """
    now = stored(
        edges.where(F.col("item") != F.col("root")).select(
            F.greatest("item", "root").alias("u"), F.least("item", "root").alias("v")
        ).distinct(),
        "edges",
    )
    seen = None
    while True:
        look = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if look == seen or look[0] == 0:
            return now.select(F.col("u").alias("item"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("item"), F.col("v").alias("component")).distinct()
            )
        seen = look
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        larger = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hooked = smaller.unionByName(least.select("u", F.col("m").alias("v")))
        before, now = now, stored(hooked.distinct(), "edges")
        release(before)


def clustered(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, n_links) and (item, component) of verified rows."""
    kept = stored(found, "links")
    return kept.groupBy("item").agg(F.sum("n").alias("n_links")), components(kept.select("item", "root"))
