"""Shards of equal texts by best-fit-decreasing bin packing.

A group is all rows with one text; it is never split. Groups are packed in two steps, so that no
task and not the driver sees them all:

1. Every task packs its groups, largest first, into crates of a fixed capacity. A group enters
   the crate with the least room that still holds it; a balanced tree over the rooms finds it.
   A group larger than a crate is a crate of its own. At most one crate of a task is less than
   half full, so crates number at most twice the bytes over the capacity, plus one per task.
2. Crates are packed into the shards the same way. For a given number of shards the capacity is
   bisected to the least one that suffices. Crates are 1/CRATES_PER_SHARD of a shard, so there are
   at most 2 * CRATES_PER_SHARD * shards of them and one per task: a bounded list.

Rows: a null text counts eight bytes, has checksum 0 and is a group of its own, apart from the
empty text. Repeated rows are rows like others and get their own slots. Ties in size are placed
in the order of the texts' hashes. Very long texts are read whole where they lie; only their digest,
size and checksum are shuffled. Other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from candlewick.llm.common import stored

ROW_OVERHEAD = 8
CRATES_PER_SHARD = 256
SLOT_BUCKETS = 256
BISECTIONS = 24


class RoomTree:
    """Keys (room, bin) in a treap: a search tree that random priorities keep balanced."""

    def __init__(self) -> None:
        self.root = None
        self._state = 0x9E3779B97F4A7C15

    def add(self, key: tuple[int, int]) -> None:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        small, large = _split(self.root, key)
        self.root = _merge(_merge(small, [key, self._state >> 32, None, None]), large)

    def take(self, least: tuple[int, int]) -> tuple[int, int] | None:
        """The smallest key of at least ``least``, taken out."""
        node, found = self.root, None
        while node is not None:
            if node[0] >= least:
                node, found = node[2], node[0]
            else:
                node = node[3]
        if found is not None:
            small, rest = _split(self.root, found)
            _, large = _split(rest, (found[0], found[1] + 1))
            self.root = _merge(small, large)
        return found


def _split(node, key):
    """Subtrees with the keys below ``key`` and the others."""
    if node is None:
        return None, None
    if node[0] < key:
        node[3], large = _split(node[3], key)
        return node, large
    small, node[2] = _split(node[2], key)
    return small, node


def _merge(small, large):
    if small is None or large is None:
        return large if small is None else small
    if small[1] > large[1]:
        small[3] = _merge(small[3], large)
        return small
    large[2] = _merge(small, large[2])
    return large


class BestFit:
    """Bins of one capacity. Sizes must come largest first; larger ones get a bin of their own."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.bins, self.tree = capacity, 0, RoomTree()

    def place(self, size: int) -> int:
        found = self.tree.take((size, -1)) if size <= self.capacity else None
        if found is None:
            found, self.bins = (self.capacity, self.bins), self.bins + 1
        room, place = found
        if room > size:
            self.tree.add((room - size, place))
        return place


def pack(groups: DataFrame, capacity: int) -> DataFrame:
    """The rows (digest, size) with ``crate``: best-fit-decreasing bins of a fixed capacity.

    Each task packs the groups it holds, so bins are as few as the method gives, plus at most
    one underfilled bin per task.
    """

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, first = BestFit(capacity), TaskContext.get().partitionId() << 40
        for batch in batches:
            yield batch.assign(crate=[first + bins.place(size) for size in batch["size"].tolist()])

    ordered = groups.select("digest", "size").sortWithinPartitions(F.desc("size"), "digest")
    return ordered.mapInPandas(packed, "digest string, size long, crate long")


def spread(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size (largest first) with the least capacity that needs no more shards.

    Sizes over the mean of what is left get a shard of their own first.
    """
    total, alone = sum(sizes), 0
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, left = sizes[alone:], shards - alone
    low = max(-(-total // left), rest[0] if rest else 0)
    high, best = 2 * low, None
    for _ in range(BISECTIONS):
        capacity = low if best is None and high == 2 * low else (low + high) // 2
        bins = BestFit(capacity)
        places = [bins.place(size) for size in rest]
        if bins.bins <= left:
            best, high = places, capacity
        else:
            low = capacity + 1
        if low >= high and best is not None:
            break
    if best is None:
        bins = BestFit(high)
        best = [bins.place(size) for size in rest]
    return [*range(alone), *(alone + place for place in best)]


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the text's digest, which is null for a null text."""
    body = F.col(f"`{text}`")
    data = F.coalesce(body, F.lit("")).cast("binary")
    return docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        (F.octet_length(data) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.coalesce(F.sha2(body.cast("binary"), 256), F.lit("null")).alias("digest"),
    )


def shard_documents(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: ``shards`` shards whose bytes are nearly equal."""
    spark = docs.sparkSession
    rows = stored(measured(docs, id_column, text), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    crates = stored(pack(groups, max(1, total // (shards * CRATES_PER_SHARD))), "shard-crates")
    sizes = crates.groupBy("crate").agg(F.sum("size").alias("size"))
    listed = sorted(((r["size"], r["crate"]) for r in sizes.collect()), key=lambda x: (-x[0], x[1]))
    places = spread([size for size, _ in listed], shards)
    placed = spark.createDataFrame(
        [(crate, place) for (_, crate), place in zip(listed, places, strict=True)],
        "crate long, shard int",
    )
    of_text = crates.join(F.broadcast(placed), "crate").select("digest", "shard")
    return with_slots(stored(rows.join(of_text, "digest").drop("digest"), "shard-placed"))


def with_slots(rows: DataFrame) -> DataFrame:
    """Gapless slots from 0 in each shard, numbered in buckets so that no task sorts a shard."""
    buckets = rows.withColumn("bucket", F.pmod(F.hash("doc_id"), F.lit(SLOT_BUCKETS)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = buckets.withColumn("place", F.row_number().over(within))
    # One row per shard and bucket: its size is fixed by the two parameters.
    return numbered.join(F.broadcast(starts), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("start") + F.col("place") - 1).alias("slot"),
    )
