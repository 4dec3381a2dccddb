"""The manifest against plain trees built in one list."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from candlewick.llm import merkle
from candlewick.llm.merkle import Block, copied, height


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[k:k + 16])) for k in range(0, len(below), 16)])
    return levels


def plain_proof(levels, place):
    proof = []
    for nodes in levels[:-1]:
        first = place - place % 16
        proof.append("".join(n for k, n in enumerate(nodes[first:first + 16], first) if k != place))
        place //= 16
    return proof


def plain_root(nodes, place, changed):
    return plain_levels([*nodes[:place], changed, *nodes[place + 1:]])[-1][0]


def plain_manifest(leaves):
    """Rows by (tree, place); ``leaves`` are (tree, key, digest, changed)."""
    def order(value):
        return (value is not None, value)

    names = sorted({t for t, *_ in leaves}, key=order)
    trees = [sorted((x for x in leaves if x[0] == t), key=lambda x: (order(x[1]), x[2])) for t in names]
    built = [plain_levels([d for _, _, d, _ in tree]) for tree in trees]
    above = plain_levels([levels[-1][0] for levels in built])
    rows = []
    for k, (tree, levels) in enumerate(zip(trees, built, strict=True)):
        for place, (t, key, own, changed) in enumerate(tree):
            subroot = plain_root(levels[0], place, changed or own)
            root = plain_root(above[0], k, subroot)
            proof = plain_proof(levels, place) + plain_proof(above, k)
            rows.append((key, own, t, place, levels[-1][0], above[-1][0], proof, changed, root))
    return rows


def leaves_of(sizes, seed=1):
    pick = random.Random(seed)
    rows = []
    for name, size in sizes.items():
        for k in range(size):
            changed = digest(f"new {name} {k}") if pick.random() < 0.1 else None
            rows.append((name, k * 3, digest(f"{name} {k}"), changed))
    pick.shuffle(rows)
    return rows


SCHEMA = "tree string, key long, digest string, changed string"


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle.manifest(frame).collect()
    def key(r):
        return (r[2] is not None, r[2], r[3])

    want = sorted(plain_manifest(rows), key=key)
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=key), want, strict=True):
        assert (r.key, r.leaf, r.tree, r.position, r.subroot, r.root, r.proof) == w[:7]
        assert r.folded_root == w[8] and r.verified == (w[8] == r.root)
        if w[7] is None:
            assert r.copied is None and r.verified
        else:
            # One node of its own for each level, whatever the size of the tree.
            assert len(r.copied) == len(r.proof) and (r.copied or [w[7]])[-1] == r.folded_root
    return got


def test_trees_of_many_sizes(spark):
    sizes = {None: 40, "a": 1, "b": 2, "é": 16, "c": 17, "d": 256, "e": 257, "f": 4097, "": 3}
    check(spark, leaves_of(sizes))


def test_many_small_trees(spark):
    check(spark, leaves_of({f"s{k}": 1 + k % 3 for k in range(300)}))


@pytest.mark.parametrize("sizes", [{"one": 1}, {"one": 20}, {None: 1, "b": 1}])
def test_few_rows(spark, sizes):
    check(spark, leaves_of(sizes))


def test_ties_repeats_and_nulls(spark):
    rows = [("t", None, digest("n"), None), ("t", 1, digest("x"), digest("X")), ("t", 1, digest("x"), digest("X")),
            ("t", 1, digest("a"), None), ("t", 1, digest("z"), digest("z")), (None, 5, digest("q"), None)]
    found = check(spark, rows * 30)
    # A change that changes nothing verifies.
    assert all(r.verified for r in found if r.leaf == digest("z"))
    assert not any(r.verified for r in found if r.leaf == digest("x"))


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_hot_tree_is_spread_over_tasks(spark):
    rows = spark.range(20_000).selectExpr("'t' AS tree", "id AS key", "'x' AS digest", "null AS changed")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        ranged = merkle.in_ranges(rows, "key")
        placed = merkle.numbered(rows, "key")
        assert placed.where("position <> key OR total <> 20000").count() == 0
    finally:
        spark.conf.set(name, "true")
    counts = [r["count"] for r in ranged.groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(counts) == 4 and max(counts) < 10_000


def test_leaf_digest(spark):
    frame = spark.createDataFrame([(7, None, "aé"), (None, "", "x" * 300_000)], "a long, b string, c string")
    rows = frame.select(merkle.leaf_digest(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in rows] == [digest("1:7-3:aé"), digest("-0:300000:" + "x" * 300_000)]


def test_blocks_share_what_has_not_changed():
    nodes = [digest(str(k)) for k in range(200)]
    block = Block(nodes, 200)
    assert height(200) == 2 and block.top == plain_levels(nodes)[-1][0]
    version = copied(digest("new"), block.beside(77))
    changed = plain_levels([*nodes[:77], digest("new"), *nodes[78:]])
    assert version == [changed[1][4], changed[2][0]]
