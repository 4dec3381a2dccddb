"""Token ids packed into rows of fixed length by best-fit decreasing.

A text becomes its token ids and an end id. One with more ids than a row is cut into full rows and a
rest, so no token is lost. The rests of a window of documents are sorted by length, longest first; each
enters the row with the least room that still holds it, which a segment tree over the possible
amounts of room finds. Full rows need no search.

Documents are packed where they are read, in windows of about WINDOW_TOKENS tokens, so nothing is
shuffled and memory does not depend on the table. A lost task packs its documents again in the
same way. A row of the result holds

* ``pack_id``: unique long,
* ``ids``: ``row_tokens`` little-endian ids (two bytes, or four if the vocabulary needs them),
  padded with the end id,
* ``positions``: as many positions, which start at 0 in each segment and in the padding,
* ``cu_seqlens``: the cumulative segment lengths, starting with 0,
* ``doc_ids``, ``offsets``: the document of each segment and the place of its first token.

Rows: a null or empty text is one end id, so every row of the table is found again. Very long texts,
and very long runs of white space in them, are encoded whole, like any other. Repeated rows and null
ids are packed like any other; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import small_batches

ROW_TOKENS = 2048
WINDOW_TOKENS = 1 << 22
EMIT_ROWS = 512
# The pattern that the public byte-level vocabulary was made with.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# What the pattern takes for white space.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_WHITE = 10_000

SCHEMA = (
    "pack_id long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, "
    "offsets array<int>"
)


def read_ranks(data: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def tokenizer(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "packing", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encoder(ranks: dict[bytes, int], long_white: int = LONG_WHITE) -> Callable[[str], list[int]]:
    """A text's ids. The pattern's matcher gives up on very long white space, so that is cut off first,
    where the pattern cuts it: before it, and before its last character unless the text ends there."""
    coder = tokenizer(ranks)
    long_run = re.compile(f"{WHITE}{{{long_white},}}")

    def encode(text: str) -> list[int]:
        if len(text) < long_white:
            return coder.encode_ordinary(text)
        ids, start = [], 0
        for run in long_run.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += coder.encode_ordinary(text[start:run.start()])
            ids += coder._encode_single_piece(text[run.start():end])
            start = end
        return ids + coder.encode_ordinary(text[start:])

    return encode


class RoomTree:
    """Open rows by the room they have left: a segment tree over the amounts of room."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``size``, taken out; with its room."""
        node, count = self.leaves + size, self.count
        while not count[node]:
            while node & 1:  # a right child: go up to where a right sibling exists
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.leaves
        row = self.rows[room].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return row, room


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The row of each piece, pieces being given longest first."""
    tree, rows, places = RoomTree(capacity), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            found, rows = (rows, capacity), rows + 1
        row, room = found
        places.append(row)
        if room > size:
            tree.add(room - size, row)
    return places


class Window:
    """Documents' ids until there are enough to pack."""

    def __init__(self, capacity: int, end_id: int, kind: str) -> None:
        self.capacity, self.end_id, self.kind = capacity, end_id, kind
        self.segments: list[tuple[int | None, int, np.ndarray]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.capacity):
            self.segments.append((doc_id, start, ids[start:start + self.capacity]))
        self.tokens += len(ids)

    def rows(self) -> Iterator[list[tuple[int | None, int, np.ndarray]]]:
        order = sorted(self.segments, key=lambda s: -len(s[2]))
        places = best_fit([len(s[2]) for s in order], self.capacity)
        packed: list[list] = [[] for _ in range(max(places, default=-1) + 1)]
        for place, segment in zip(places, order, strict=True):
            packed[place].append(segment)
        self.segments, self.tokens = [], 0
        yield from packed

    def batches(self, first_id: int) -> Iterator[pa.RecordBatch]:
        rows = list(self.rows())
        for start in range(0, len(rows), EMIT_ROWS):
            yield self._batch(first_id + start, rows[start:start + EMIT_ROWS])

    def _batch(self, first_id: int, rows: list[list]) -> pa.RecordBatch:
        size = self.capacity
        ids = np.full((len(rows), size), self.end_id, self.kind)
        positions = np.zeros((len(rows), size), self.kind)
        lengths = []
        for k, row in enumerate(rows):
            ends = np.cumsum([0, *(len(part) for _, _, part in row)])
            starts = np.append(ends, size) if ends[-1] < size else ends
            ids[k, :ends[-1]] = np.concatenate([part for _, _, part in row])
            steps = np.diff(starts)
            positions[k] = np.arange(size) - np.repeat(starts[:-1], steps)
            lengths.append(ends.tolist())
        return pa.RecordBatch.from_arrays([
            pa.array(range(first_id, first_id + len(rows)), pa.int64()),
            _binary(ids), _binary(positions),
            pa.array(lengths, pa.list_(pa.int32())),
            pa.array([[doc for doc, _, _ in row] for row in rows], pa.list_(pa.int64())),
            pa.array([[start for _, start, _ in row] for row in rows], pa.list_(pa.int32())),
        ], names=["pack_id", "ids", "positions", "cu_seqlens", "doc_ids", "offsets"])


def _binary(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))]
    return pa.Array.from_buffers(pa.binary(), len(matrix), buffers)


def pack_documents(
    docs: DataFrame, ranks_path: str, end_id: int, id_column: str = "doc_id", text: str = "text",
    row_tokens: int = ROW_TOKENS, window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """The packed rows. The vocabulary file is read on the driver; its size is fixed."""
    with open(ranks_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(shared.value)
        encode = encoder(ranks)
        kind = "<u2" if max(max(ranks.values()), end_id, row_tokens) < 1 << 16 else "<u4"
        window = Window(row_tokens, end_id, kind)
        next_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = encode(text.as_py() or "")
                found.append(end_id)
                window.add(doc_id, np.array(found, kind))
                if window.tokens >= window_tokens:
                    for out in window.batches(next_id):
                        next_id += out.num_rows
                        yield out
        yield from window.batches(next_id)

    source = small_batches(docs).select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return source.mapInArrow(packed, SCHEMA)


def matrix(rows: list, column: str = "ids", row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """Collected packed rows as one matrix of ids or positions."""
    width = len(rows[0][column]) // row_tokens if rows else 2
    data = b"".join(bytes(row[column]) for row in rows)
    return np.frombuffer(data, f"<u{width}").reshape(-1, row_tokens)


def write_packed(packed: DataFrame, folder: str) -> None:
    """Packed rows as Parquet files whose binary columns are rows of the matrices.

    Spark's own writer commits them, so a lost executor leaves neither gaps nor doubles, and the
    folder can be in any store that Spark reaches.
    """
    packed.write.parquet(folder)


def unpack_row(row, row_tokens: int = ROW_TOKENS) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """The segments (doc_id, offset, ids) of one packed row."""
    ids = np.frombuffer(row.ids, f"<u{len(row.ids) // row_tokens}")
    for k, (doc_id, offset) in enumerate(zip(row.doc_ids, row.offsets, strict=True)):
        yield doc_id, offset, ids[row.cu_seqlens[k]:row.cu_seqlens[k + 1]]
