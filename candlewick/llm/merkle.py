"""Merkle manifest of a dataset: persistent trees of FANOUT children, with path-copied versions.

Every leaf belongs to a tree, in which leaves follow each other by key. Of each level FANOUT
consecutive nodes, the last few of a level being fewer, become the digest of their digests, until one
node remains, the tree's subroot. The subroots, in the order of their trees, are the leaves of one
more tree, whose last node is the root.

Trees are built in blocks: aligned runs of FANOUT ** BLOCK_LEVELS nodes. A task holds one block at a
time and computes its BLOCK_LEVELS levels; what it hands on is the top, so a pass leaves one row of
BLOCK, and a few passes build a tree of any size, whichever tree the rows belong to. On the way
back each block gets what lies beside its top on every level above it.

A changed leaf makes a version of the tree. The version shares every node but the leaf's ancestors,
which it copies: within the block from the block's own nodes, above it by the nodes beside the
block's ancestors, up to the root. So a version costs its height in nodes, and versions of
different leaves are independent of each other, wherever they are computed.

Places in a tree come from a sort into ranges and the ranges' counts; a hot tree, and a hot key, is
sorted by many tasks.

Rows: null trees are a tree, the first one. Null keys come first. Rows of equal keys follow each other
by digest; repeated rows are leaves like others, and which of them comes first makes no
difference. Long texts enter by their digests. A tree of one leaf has it as subroot. Other columns
are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.llm.common import stored

FANOUT = 16
BLOCK_LEVELS = 2
BLOCK = FANOUT**BLOCK_LEVELS

PATH = "array<struct<left: string, right: string>>"
NODES = "tree string, position long, total long, digest string"
ENDS = f"tree string, position long, path {PATH}, subroot string, root string"

Path = list[tuple[str, str]]


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value is ``-`` if null, else its byte count, a colon and itself."""
    texts = [value.cast("string") for value in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def node_digest(children: str) -> str:
    return sha256(children.encode()).hexdigest()


def height(total: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while total > 1:
        total, levels = -(-total // FANOUT), levels + 1
    return levels


class Block:
    """The nodes of one aligned block, level by level, below a single top."""

    def __init__(self, digests: Sequence[str], total: int) -> None:
        self.levels = [list(digests)]
        for _ in range(min(BLOCK_LEVELS, height(total))):
            below = self.levels[-1]
            self.levels.append([
                node_digest("".join(below[k:k + FANOUT])) for k in range(0, len(below), FANOUT)
            ])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def beside(self, place: int) -> Path:
        """What lies left and right of a leaf and its ancestors in their runs, up to the top."""
        path = []
        for nodes in self.levels[:-1]:
            first = place - place % FANOUT
            path.append(("".join(nodes[first:place]), "".join(nodes[place + 1:first + FANOUT])))
            place //= FANOUT
        return path


def copied(digest: str, path: Path) -> list[str]:
    """The ancestors of a node in a version where it has this digest, from its parent up."""
    nodes = []
    for left, right in path:
        digest = node_digest(left + digest + right)
        nodes.append(digest)
    return nodes


# ---- places ------------------------------------------------------------------------------


def in_ranges(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``_at``: their range, shifted left by 33 bits, and their place in it.

    A hot tree, and a hot key, fill many ranges. The rows are written once: what a range holds must
    not change between its count and its use.
    """
    salted = rows.withColumn("_row", F.monotonically_increasing_id())
    by = ["tree", *order, "_row"]
    ranged = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    return stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-ordered")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``position`` in their ``tree`` and ``total``, the number of its rows."""
    ordered = in_ranges(rows, *order)
    part = F.shiftright("_at", 33)
    spans = ordered.groupBy("tree", part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        F.col("tree").alias("_tree"), "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_tree).alias("total"),
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (part == F.col("_part"))
    return ordered.join(starts, same).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("position"), "total"
    )


# ---- blocks ------------------------------------------------------------------------------


def gathered(rows: DataFrame) -> DataFrame:
    """Rows of one block next to each other, by position."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(tree, block) and the other columns' rows, one block after the other."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_TEXT, _LONG = pa.string(), pa.int64()
_PATH = pa.list_(pa.struct([("left", _TEXT), ("right", _TEXT)]))
_NODE_ROWS = pa.schema([("tree", _TEXT), ("position", _LONG), ("total", _LONG), ("digest", _TEXT)])
_END_ROWS = pa.schema([
    ("tree", _TEXT), ("position", _LONG), ("path", _PATH), ("subroot", _TEXT), ("root", _TEXT),
])
EMIT_ROWS = 4096


def in_block() -> Column:
    return F.expr(f"position div {BLOCK}").alias("block")


def tops(nodes: DataFrame) -> DataFrame:
    """The top of every block, as nodes of the next pass."""

    def climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (tree, block), rows in blocks_of(batches):
            total = rows[0][1]
            top = Block([digest for _, _, digest in rows], total).top
            out.append((tree, block, -(-total // BLOCK), top))
            if len(out) == EMIT_ROWS:
                yield _batch(out, _NODE_ROWS)
                out = []
        if out:
            yield _batch(out, _NODE_ROWS)

    rows = nodes.select("tree", in_block(), "position", "total", "digest")
    return gathered(rows).mapInArrow(climbed, NODES)


def passes(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, the tops of their blocks, the tops of these and so on, to one node per tree."""
    built = [nodes.select("tree", "position", "total", "digest")]
    while (built[-1].agg(F.max("total")).first()[0] or 0) > 1:
        built.append(stored(tops(built[-1]), "merkle-tops"))
    return built


def with_ends(nodes: DataFrame, ends: DataFrame, *payload: str) -> DataFrame:
    """Nodes by block, each block led by a row with the path above its top."""
    header = ends.select(
        "tree", F.col("position").alias("block"), F.lit(-1).cast("long").alias("position"),
        "path", "subroot", "root",
    )
    rows = nodes.select("tree", in_block(), "position", "total", "digest", *payload)
    joined = rows.unionByName(header, allowMissingColumns=True)
    return gathered(joined)


def descend(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The whole path above every node, from the paths above the blocks' tops."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (head, *rows) in blocks_of(batches):
            above = [(step["left"], step["right"]) for step in head[3]]
            block = Block([row[2] for row in rows], rows[0][1])
            out = []
            for place, row in enumerate(rows):
                path = [{"left": a, "right": b} for a, b in block.beside(place) + above]
                out.append((tree, row[0], path, head[4], head[5]))
            yield _batch(out, _END_ROWS)

    return with_ends(nodes, ends).mapInArrow(extended, ENDS)


def paths(built: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The paths above the tops of the first pass's blocks, from those above the last nodes."""
    for nodes in built[:0:-1]:
        ends = stored(descend(nodes, ends), "merkle-paths")
    return ends


# ---- the manifest ------------------------------------------------------------------------


def forest(subroots: DataFrame) -> DataFrame:
    """Of every tree the path above its subroot, the subroot and the root of all."""
    named = subroots.select(
        F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"), "digest",
    )
    placed = stored(numbered(named, "name"), "merkle-subroots")
    built = passes(placed)
    no_path = F.array().cast(PATH)
    ends = built[-1].select(
        "tree", F.lit(0).cast("long").alias("position"), no_path.alias("path"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    above = descend(placed, paths(built, ends)).select("position", "path", "root")
    return placed.select("name", "position", "digest").join(above, "position").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "path",
        F.col("digest").alias("subroot"), "root",
    )


def manifest(leaves: DataFrame) -> DataFrame:
    """A row for each leaf, with its proof and, where it has changed, its version.

    ``leaves`` has ``tree``, ``key``, ``digest`` and ``changed``, the digest of a changed leaf or
    null. The result has ``key``, ``leaf``, ``tree``, ``position``, ``subroot``, ``root`` and

    * ``proof``: of each level, from the leaf's up, the digests beside it, left to right,
    * ``copied``: the nodes that the changed leaf's version has of its own, from its parent up to its
      root; null where nothing has changed,
    * ``folded_root``: the root that the leaf, changed or not, and its proof lead to,
    * ``verified``: whether that is the root.
    """
    rows = leaves.select(F.col("tree").cast("string").alias("tree"), "key", "digest", "changed")
    placed = stored(numbered(rows, "key", "digest"), "merkle-leaves")
    built = passes(placed)
    subroots = built[-1].select("tree", "digest")
    ends = paths(built, stored(forest(subroots), "merkle-forest"))
    key_type = leaves.schema["key"].dataType
    kinds = {
        "key": (key_type.simpleString(), to_arrow_type(key_type)), "leaf": ("string", _TEXT),
        "tree": ("string", _TEXT), "position": ("long", _LONG), "subroot": ("string", _TEXT),
        "root": ("string", _TEXT), "proof": ("array<string>", pa.list_(_TEXT)),
        "copied": ("array<string>", pa.list_(_TEXT)), "folded_root": ("string", _TEXT),
    }
    out_schema = pa.schema([(name, kind) for name, (_, kind) in kinds.items()])

    def proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (head, *rows) in blocks_of(batches):
            above = [(step["left"], step["right"]) for step in head[5]]
            subroot, root = head[6], head[7]
            block = Block([row[2] for row in rows], rows[0][1])
            out = []
            for place, (position, _, digest, key, changed, *_) in enumerate(rows):
                beside = block.beside(place)
                version = [changed or digest, *copied(changed or digest, beside)]
                version += copied(version[-1], above)
                proof = [left + right for left, right in beside + above]
                out.append((
                    key, digest, tree, position, subroot, root, proof,
                    version[1:] if changed else None, version[-1],
                ))
            yield _batch(out, out_schema)

    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in kinds.items())
    found = with_ends(placed, ends, "key", "changed").mapInArrow(proven, schema)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
