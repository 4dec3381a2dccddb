"""Best-fit packing against brute force, and the laws of the shards."""

from __future__ import annotations

import random
import zlib

import pytest

from candlewick.llm import sharding
from candlewick.llm.queries import QUERIES
from candlewick.llm.sharding import BestFit, RoomTree, spread


def test_tree_takes_the_least_key_that_fits():
    pick, tree, keys = random.Random(1), RoomTree(), set()
    for n in range(4000):
        if pick.random() < 0.6:
            key = (pick.randint(0, 50), n)
            tree.add(key)
            keys.add(key)
        else:
            least = (pick.randint(0, 50), -1)
            want = min((k for k in keys if k >= least), default=None)
            assert tree.take(least) == want
            keys.discard(want)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_bin(seed):
    pick = random.Random(seed)
    sizes = sorted((pick.randint(1, 120) for _ in range(400)), reverse=True)
    bins, rooms = BestFit(100), []
    for size in sizes:
        fits = [(r, k) for k, r in enumerate(rooms) if r >= size > 0 and r > 0]
        if size <= 100 and fits:
            want = min(fits)[1]
        else:
            want = len(rooms)
            rooms.append(100)
        assert bins.place(size) == want
        rooms[want] = max(0, rooms[want] - size) if size <= 100 else 0


@pytest.mark.parametrize("sizes", [[], [5], [9, 1, 1], [100, 3, 3, 3, 3], [7] * 50, [1] * 5])
def test_spread_uses_no_more_shards(sizes):
    places = spread(sizes, 4)
    assert len(places) == len(sizes) and all(0 <= p < 4 for p in places)


def test_spread_is_nearly_equal():
    pick = random.Random(2)
    sizes = sorted((pick.randint(8, 5000) for _ in range(5000)), reverse=True)
    loads = [0] * 24
    for size, place in zip(sizes, spread(sizes, 24), strict=True):
        loads[place] += size
    assert max(loads) / min(loads) < 1.002


def check(rows, docs, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in docs), key=str
    )
    slots: dict = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_documents(spark):
    out = QUERIES["op2_sharding"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(out, docs, 24)
    of_text, text = {}, {d.doc_id: d.text for d in docs}
    loads = [0] * 24
    for r in out:
        of_text.setdefault(text[r.doc_id], set()).add(r.shard)
        loads[r.shard] += r.size
    assert all(len(x) == 1 for x in of_text.values())
    assert max(loads) / min(loads) < 1.01


def test_edge_rows(spark):
    docs = [(1, None, 1), (2, "", 1), (3, "a", 1), (3, "a", 1), (None, "b", 1), (4, "x" * 3_000_000, 1)]
    docs += [(10 + k, "same", 1) for k in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, size int")
    rows = sharding.shard_documents(frame, 4).collect()
    check(rows, docs, 4)
    assert len({r.shard for r in rows if 10 <= (r.doc_id or 0)}) == 1
    assert sharding.shard_documents(frame.where("false"), 4).collect() == []


def test_fixed_capacity_bins_hold_whole_groups(spark):
    groups = spark.range(500).selectExpr("cast(id as string) digest", "(id * 37) % 91 + 1 AS size")
    bins = sharding.pack(groups.repartition(3, "digest"), 100).groupBy("crate").sum("size").collect()
    assert all(r["sum(size)"] <= 100 for r in bins)
    assert len(bins) <= 500 * 46 / 100 * 1.1 + 3
