"""Near-duplicates by SimHash over a Gray-order hierarchical index.

Two fingerprints that differ in at most three of 64 bits agree on one of four 16-bit bands. The
index therefore keeps four orders, each with another band rotated to the top. In every order the
fingerprints are sorted by Gray rank, which keeps equal leading bits together and puts patterns
that differ in one bit side by side. The sorted run is cut into blocks; inside a block, nodes of
eight children hold the bits their members share (mask and pattern). A search descends pairs of
nodes, adds up the differences on bits both sides share and drops a pair of groups once the sum
passes the limit. Equal fingerprints are one entry, and only links to a smaller member of the
same local component leave a block, so a large group never yields all its pairs.

Rows: a null or empty text, or one of white space only, has fingerprint zero and links like any
other. A row without doc_id takes part; the component is named by the smallest doc_id that is
not null. Repeated rows and ties in doc_id give equal rows. Very long texts are read whole, a run of
words at a time, so that hashes of a run and 64 counts are all that is held beside the text. Other columns are
not read; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from candlewick.llm.common import free_name, only, small_batches, stored, word_runs

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
BANDS = 4
BAND_BITS = 64 // BANDS
BLOCK_ROWS = 1024
FANOUT = 8

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- fingerprints ------------------------------------------------------------------------


def fingerprint_bytes(data: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of one text in UTF-8."""
    counts, total, carried = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for run in word_runs((data or b"").translate(_LOWER)):
        words = carried + run
        grams = [words[k:] for k in range(shingle)]
        hashes = [digest(b" ".join(gram), HASH_SEED) for gram in zip(*grams)]
        counts += _bit_counts(hashes)
        total += len(hashes)
        carried = words[-(shingle - 1):] if shingle > 1 else []
    if total == 0 and carried:
        counts, total = _bit_counts([digest(b" ".join(carried), HASH_SEED)]), 1
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def with_fingerprints(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows with their fingerprint as a long that holds the unsigned value's bits."""

    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.array([fingerprint_bytes(data, shingle) for data in batch], np.uint64)
            yield pd.Series(values.view(np.int64))

    return small_batches(docs).withColumn(name, fingerprints(F.col(f"`{text}`").cast("binary")))


# ---- Gray order --------------------------------------------------------------------------


def rotate(values: np.ndarray, bits: int) -> np.ndarray:
    if bits % 64 == 0:
        return values
    return (values << np.uint64(bits % 64)) | (values >> np.uint64(64 - bits % 64))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected Gray sequence."""
    ranks = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


def _signed_order(ranks: np.ndarray) -> np.ndarray:
    """Unsigned values as longs that sort alike."""
    return (ranks ^ np.uint64(1 << 63)).view(np.int64)


def _unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.int64).view(np.uint64) ^ np.uint64(1 << 63)


# ---- the index of a block ----------------------------------------------------------------


class GrayTree:
    """Nodes over code words in Gray order, from the code words up to few roots.

    ``levels`` goes from the roots down; each level has the shared bits of its nodes as
    ``mask`` and their values as ``pattern``. A node of level k has FANOUT children below it.
    """

    def __init__(self, codes: np.ndarray) -> None:
        mask, pattern = np.full(len(codes), _ALL), codes
        self.levels = [(mask, pattern)]
        while len(mask) > FANOUT:
            starts = np.arange(0, len(mask), FANOUT)
            ones = np.bitwise_and.reduceat(mask & pattern, starts)
            zeros = np.bitwise_and.reduceat(mask & ~pattern, starts)
            mask, pattern = ones | zeros, ones
            self.levels.append((mask, pattern))
        self.levels.reverse()

    def shared(self) -> tuple[int, int]:
        """Bits that all code words share, and their values."""
        mask, pattern = self.levels[0]
        ones = np.bitwise_and.reduce(mask & pattern)
        return int(ones | np.bitwise_and.reduce(mask & ~pattern)), int(ones)


def close_pairs(left: GrayTree, right: GrayTree, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of code words that differ in at most ``limit`` bits.

    The trees are descended together. Each step counts only the bits that became shared on
    both sides and adds them to the pair's differences so far. Both trees must be as deep;
    a tree against itself gives each pair once.
    """
    same = left is right
    a, b = (x.ravel() for x in np.indices((len(left.levels[0][0]), len(right.levels[0][0]))))
    if same:
        a, b = a[a <= b], b[a <= b]
    seen = np.zeros(len(a), np.uint64)
    apart = np.zeros(len(a), np.uint8)
    for depth, ((mask_a, code_a), (mask_b, code_b)) in enumerate(
        zip(left.levels, right.levels, strict=True)
    ):
        if depth:
            a, b, keep = _children(a, b, len(mask_a), len(mask_b), same)
            seen, apart = seen[keep], apart[keep]
        both = mask_a[a] & mask_b[b]
        apart = apart + np.bitwise_count((code_a[a] ^ code_b[b]) & both & ~seen)
        alive = apart <= limit
        a, b, seen, apart = a[alive], b[alive], both[alive], apart[alive]
    if same:
        a, b = a[a < b], b[a < b]
    return a, b


def _children(a, b, size_a: int, size_b: int, same: bool):
    parents = np.repeat(np.arange(len(a)), FANOUT * FANOUT)
    step_a, step_b = (x.ravel() for x in np.indices((FANOUT, FANOUT)))
    a = (a[:, None] * FANOUT + step_a).ravel()
    b = (b[:, None] * FANOUT + step_b).ravel()
    real = (a < size_a) & (b < size_b)
    if same:
        real &= a <= b
    return a[real], b[real], parents[real]


def _deepened(tree: GrayTree, depth: int) -> GrayTree:
    """The tree with single roots put on top until it has so many levels."""
    while len(tree.levels) < depth:
        mask, pattern = tree.levels[0]
        starts = np.arange(0, len(mask), FANOUT)
        ones = np.bitwise_and.reduceat(mask & pattern, starts)
        zeros = np.bitwise_and.reduceat(mask & ~pattern, starts)
        tree.levels.insert(0, (ones | zeros, ones))
    return tree


def forest(size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place that is linked to another, itself and the least place of its component."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    tops = np.array([find(x) for x in range(size)], np.int64)
    moved = np.flatnonzero(tops != np.arange(size))
    return moved, tops[moved]


# ---- links over all fingerprints ---------------------------------------------------------


def _orders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        codes = batch["fingerprint"].to_numpy(np.int64).view(np.uint64)
        for band in range(BANDS):
            ranks = gray_rank(rotate(codes, band * BAND_BITS))
            yield pd.DataFrame({"band": band, "rank": _signed_order(ranks)})


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (band, rank) rows as blocks of one band each."""

    def block(band: int, ranks: np.ndarray) -> dict:
        heads = (_unsigned(ranks[[0, -1]]) >> np.uint64(64 - BAND_BITS)).astype(np.int64)
        return {"band": band, "first": heads[0], "last": heads[1], "ranks": ranks}

    band, held = -1, np.zeros(0, np.int64)
    for batch in batches:
        done = []
        for now, part in batch.groupby("band", sort=True)["rank"]:
            if now != band:
                if len(held):
                    done.append(block(band, held))
                band, held = now, np.zeros(0, np.int64)
            held = np.concatenate([held, part.to_numpy(np.int64)])
            while len(held) >= BLOCK_ROWS:
                done.append(block(band, held[:BLOCK_ROWS]))
                held = held[BLOCK_ROWS:]
        if done:
            yield pd.DataFrame(done)
    if len(held):
        yield pd.DataFrame([block(band, held)])


def _fingerprints_of(band: int, ranks: np.ndarray) -> np.ndarray:
    return rotate(gray_code(_unsigned(ranks)), 64 - band * BAND_BITS)


def _links(band: int, ranks: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    moved, tops = forest(len(ranks), a, b)
    prints = _fingerprints_of(band, ranks).view(np.int64)
    return pd.DataFrame({"a": prints[moved], "b": prints[tops]})


def links(fingerprints: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links.

    ``fingerprints`` has distinct longs in ``fingerprint`` and is read more than once.
    """
    if limit >= BANDS:
        raise ValueError(f"{BANDS} bands find links of at most {BANDS - 1} bits")
    orders = stored(fingerprints.mapInPandas(_orders, "band int, rank long"), "simhash-orders")
    blocks = stored(
        orders.repartitionByRange("band", "rank").sortWithinPartitions("band", "rank")
        .mapInPandas(_cut, "band int, first long, last long, ranks array<long>")
        .withColumn("block", F.monotonically_increasing_id()),
        "simhash-blocks",
    )

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for band, ranks in zip(batch["band"], batch["ranks"], strict=True):
                tree = GrayTree(gray_code(_unsigned(ranks)))
                yield _links(band, ranks, *close_pairs(tree, tree, limit))

    def between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for band, one, two in zip(batch["band"], batch["ranks"], batch["ranks_2"], strict=True):
                trees = [GrayTree(gray_code(_unsigned(part))) for part in (one, two)]
                depth = max(len(tree.levels) for tree in trees)
                a, b = close_pairs(*(_deepened(tree, depth) for tree in trees), limit)
                yield _links(band, np.concatenate([one, two]), a, b + len(one))

    within = blocks.select("band", "ranks").mapInPandas(inside, "a long, b long")
    across = _crossing(blocks, limit).mapInPandas(between, "a long, b long")
    return within.unionByName(across)


def _crossing(blocks: DataFrame, limit: int) -> DataFrame:
    """Pairs of blocks that hold fingerprints with the same band and may be close.

    Blocks follow each other in Gray order, so a band value spans two blocks only as the last
    of one and the first of the other. Nodes of whole blocks are compared before their members.
    """
    ends = blocks.select(
        "band", "block", F.explode(F.array_distinct(F.array("first", "last"))).alias("head"),
        "ranks",
    )
    spans = ends.groupBy("band", "head").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hot = ends.join(spans, ["band", "head"]).select("band", "head", "block", "ranks").mapInPandas(
        _with_node, "band int, head long, block long, ranks array<long>, mask long, pattern long"
    )
    two = hot.select(
        "band", "head", *(F.col(c).alias(f"{c}_2") for c in ("block", "ranks", "mask", "pattern"))
    )
    shared = F.col("mask").bitwiseAND(F.col("mask_2"))
    apart = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern_2")).bitwiseAND(shared))
    return hot.join(two, ["band", "head"]).where(
        (F.col("block") < F.col("block_2")) & (apart <= limit)
    ).select("band", "ranks", "ranks_2")


def _with_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks cut down to their members with the band value ``head``, with the node over them."""
    for batch in batches:
        parts, nodes = [], []
        for head, ranks in zip(batch["head"], batch["ranks"], strict=True):
            bands = _unsigned(ranks) >> np.uint64(64 - BAND_BITS)
            parts.append(ranks[bands == np.uint64(head)])
            nodes.append(GrayTree(gray_code(_unsigned(parts[-1]))).shared())
        node = np.array(nodes, np.uint64).reshape(-1, 2).view(np.int64)
        yield batch.assign(ranks=parts, mask=node[:, 0], pattern=node[:, 1])


# ---- components --------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    Large-star and small-star steps alternate until the edges stay as they are. Every step is
    a minimum per node and a join back to the edges, so a node with many neighbours is reduced
    before the shuffle and split by adaptive execution in the join. Each round is stored.
    """
    both = edges.where("a <> b")
    edges = stored(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    before = _checksum(edges)
    while True:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m"))
        large = around.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b")
        ).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(
            F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("e")
        ).select("e.*").where("a <> b").distinct()
        edges = stored(small, "components")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())


def _components_of(docs: DataFrame, id_column: str, text: str, shingle: int, limit: int) -> DataFrame:
    """doc_id, text_key, fingerprint, component (its least fingerprint), component_id per row."""
    texts = only(docs, id_column, text).toDF("doc_id", "text")
    prints = stored(
        with_fingerprints(texts, "text", shingle=shingle).select(
            "doc_id", "fingerprint", _text_key(F.col("text")).alias("text_key")
        ),
        "simhash-prints",
    )
    distinct = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    joined = components(links(distinct.select("fingerprint"), limit))
    # A fingerprint without links is a component of its own.
    member = distinct.join(joined, distinct.fingerprint == joined.node, "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    named = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    lookup = member.join(named, "component").select("fingerprint", "component", "component_id")
    return prints.join(lookup, "fingerprint")


def _text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("binary"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE_WORDS, limit: int = MAX_BITS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id.

    component_id is the least doc_id of the documents that chains of links reach.
    """
    found = _components_of(docs, id_column, text, shingle, limit)
    return found.select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE_WORDS, limit: int = MAX_BITS,
) -> DataFrame:
    """One row of each component, with its own columns: that of the least id.

    A row without id stands for a component only if no other can. Among different texts with that
    id, one is chosen by hash; of rows equal in id and text, one stays.
    """
    found = _components_of(docs, id_column, text, shingle, limit)
    rows = found.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("n"))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n")
    kept = stored(
        rows.groupBy("component").agg(F.min(least).alias("k")).select("k.doc_id", "k.text_key", "k.n"),
        "simhash-kept",
    ).alias("k")
    same = F.col(f"d.`{id_column}`").eqNullSafe(F.col("k.doc_id")) & (
        _text_key(F.col(f"d.`{text}`")) == F.col("k.text_key")
    )
    own = docs.alias("d")
    single = own.join(kept.where("n = 1"), same, "left_semi")
    repeated = kept.where("n > 1").alias("k")
    if repeated.isEmpty():
        return single
    place = free_name(docs, "_place")
    order = Window.partitionBy(f"`{id_column}`", _text_key(F.col(f"`{text}`"))).orderBy(F.lit(1))
    first = own.join(repeated, same, "left_semi").withColumn(place, F.row_number().over(order))
    return single.unionByName(first.where(f"`{place}` = 1").drop(place))
