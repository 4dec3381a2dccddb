"""SentencePiece encoding and decoding by a Viterbi pass over shared prefixes.

The vocabulary writes a blank as the mark U+2581; here both are blanks. A text is cut into marked
words: no piece of the vocabulary has a mark after another character, nor a line end, so no piece
crosses a cut. Each batch of texts takes the
distinct words it has not met yet, sorts them, and walks them as the paths of a trie, depth
first: the forward table of a word is kept while the next word shares its prefix, and only the
rest is computed.

The forward table depends on the kind of model. For a unigram model it holds the best score of
each prefix, as usual. For a merge (BPE) model the scores are merge ranks and their sum means
nothing; there the table holds the one last piece of each prefix that merging would give: a piece
may follow another if merging the two texts alone leaves exactly these two. That gives the ids
that merging gives, from left to right, with the same sharing.

Rows: a null text has null ids and null decodes to null; an empty text has no ids. Characters
outside the vocabulary become byte pieces, or the unknown id if the model has none. A text that
holds the mark U+2581 itself decodes with a blank in its place. Repeated rows get equal ids.
Other columns pass through; one named like a new column is replaced. Long texts are cut like short ones; the word table of a worker
stops growing at CACHE_WORDS words, which changes no result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

from candlewick.llm.common import small_batches, without

MARK, BLANK = "▁", " "
CACHE_WORDS = 300_000
CACHE_PAIRS = 300_000
SLICE_BYTES = 1 << 20
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """The vocabulary of a model file: pieces with scores, byte pieces and the unknown id."""

    def __init__(self, proto: bytes) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are supported")
        self.merges = model.trainer_spec.model_type == BPE
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.ids, self.scores, self.byte_ids, self.texts = {}, {}, {}, []
        self.unknown = 0
        for k, piece in enumerate(model.pieces):
            text = b""
            if piece.type in (NORMAL, USER):
                name = piece.piece.replace(MARK, BLANK)
                self.ids[name], self.scores[name] = k, piece.score
                text = name.encode()
            elif piece.type == BYTE:
                self.byte_ids[int(piece.piece[1:-1], 16)] = k
                text = bytes([int(piece.piece[1:-1], 16)])
            elif piece.type == UNKNOWN:
                self.unknown, text = k, " ⁇ ".encode()
            self.texts.append(text)
        self.suffixes = {piece[k:] for piece in self.ids for k in range(len(piece))}
        self.floor = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self._fits: dict[tuple[str, str], bool] = {}
        self._known: dict[str, bytes] = {}

    @cached_property
    def words(self) -> re.Pattern:
        """Finds the marked words of a text with marks.

        Where the vocabulary allows it, letters and other characters are words of their own: the
        others start as all that are not letters and lose those that a piece joins to a letter.
        """
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            return re.compile(".+", re.DOTALL)
        if any("\n" in piece for piece in self.ids):
            return re.compile(" +[^ ]*|[^ ]+")
        bare = [piece.lstrip(BLANK) for piece in self.ids]
        joined = {pair for piece in bare for pair in pairwise(piece)}
        others = {char for piece in bare for char in piece if not char.isalpha()}
        while mixed := {c for a, b in joined if (a in others) != (b in others) for c in (a, b)} & others:
            others -= mixed
        if not others:
            return re.compile(r" +[^ \n]*|[^ \n]+|\n")
        chars = "".join(map(re.escape, sorted(others)))
        return re.compile(f" *[^ \n{chars}]+| *[{chars}]+| +|\n")

    # ---- merge models

    def merged(self, text: str) -> list[str]:
        """The pieces that merging adjacent pairs leaves: best score first, then leftmost."""
        parts: list[str | None] = list(text)
        left = list(range(-1, len(parts) - 1))
        right = list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                pair = parts[a] + parts[b]
                if pair in self.scores:
                    heapq.heappush(queue, (-self.scores[pair], a, pair))

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        while queue:
            _, a, pair = heapq.heappop(queue)
            b = right[a] if parts[a] is not None else len(parts)
            if b >= len(parts) or parts[a] + parts[b] != pair:
                continue
            parts[a], parts[b] = pair, None
            right[a] = right[b]
            if right[b] < len(parts):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [part for part in parts if part is not None]

    def follows(self, before: str, piece: str) -> bool:
        """Whether merging leaves the texts of two reachable pieces apart.

        It does unless a pair across their border is merged before a better one inside.
        """
        score, parts, border = self.scores.get, [*before, *piece], len(before)
        fits = None
        while fits is None:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):  # on equal scores the leftmost pair goes first
                own = score(parts[k] + parts[k + 1])
                if own is not None and own > best:
                    best, at = own, k
            if at == border - 1:
                fits = False
            elif at < 0:
                fits = True
            else:
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                border -= at < border
        if len(self._fits) >= CACHE_PAIRS:
            self._fits.clear()
        self._fits[before, piece] = fits
        return fits

    @cached_property
    def reachable(self) -> dict[str, str]:
        """The pieces that merging their own text gives, each to the one string that stands for it."""
        return {piece: piece for piece in self.ids if self.merged(piece) == [piece]}

    # ---- the forward pass over sorted words

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each distinct word with its pieces, in the order of a depth-first walk of the trie."""
        extend = self._extend_merges if self.merges else self._extend_scores
        path: list = [("", 0.0)]
        last = ""
        for word in sorted(words):
            if self.merges and word.startswith(BLANK * 2):
                yield word, self.merged(word)  # runs of marks have equal scores
                continue
            del path[_common_prefix(last, word) + 1:]
            extend(word, path)
            last = word
            pieces, end = [], len(word)
            while end:
                piece = path[end][0]
                pieces.append(piece)
                end -= len(piece)
            yield word, pieces[::-1]

    def _extend_merges(self, word: str, path: list) -> None:
        reachable, fits, suffixes = self.reachable, self._fits, self.suffixes
        for end in range(len(path), len(word) + 1):
            start = end - 1
            while start > 0 and word[start - 1:end] in suffixes:
                start -= 1
            best = word[end - 1]
            for begin in range(start, end - 1):
                piece = reachable.get(word[begin:end])
                if piece is not None:
                    before = path[begin][0]
                    if not before or (
                        fits[before, piece] if (before, piece) in fits else self.follows(before, piece)
                    ):
                        best = piece
                        break
            path.append((best, 0.0))

    def _extend_scores(self, word: str, path: list) -> None:
        for end in range(len(path), len(word) + 1):
            start = end - 1
            while start > 0 and word[start - 1:end] in self.suffixes:
                start -= 1
            best, score = "", -np.inf
            for begin in range(start, end):
                piece = word[begin:end]
                own = self.scores.get(piece, self.floor if begin == end - 1 else None)
                if own is not None and path[begin][1] + own > score:
                    best, score = piece, path[begin][1] + own
            path.append((best, score))

    def piece_ids(self, pieces: list[str]) -> list[int]:
        found: list[int] = []
        for piece in pieces:
            if piece in self.ids:
                found.append(self.ids[piece])
            elif self.byte_ids:
                found += [self.byte_ids[b] for b in piece.encode()]
            else:
                found.append(self.unknown)
        return found

    # ---- whole texts

    def encoder(self):
        """A function from a list of texts to int32 id arrays; it remembers words."""
        known = self._known

        def encode(texts: list[str | None]) -> list[np.ndarray | None]:
            cut = [None if text is None else self.words.findall(self._marked(text)) for text in texts]
            fresh = {word for words in cut if words for word in words} - known.keys()
            coded = {
                word: np.array(self.piece_ids(pieces), "<i4").tobytes()
                for word, pieces in self.encode_words(fresh)
            }
            if len(known) < CACHE_WORDS:
                known.update(coded)
            get = known.get
            return [
                None if words is None
                else np.frombuffer(b"".join([get(w) or coded[w] for w in words]), "<i4")
                for words in cut
            ]

        return encode

    def _marked(self, text: str) -> str:
        marked = text.replace(MARK, BLANK)
        return BLANK + marked if text and self.prefix else marked

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join([self.texts[k] for k in ids.tolist()])
        if self.prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_model(proto: bytes) -> PieceModel:
    """The model of a Python worker; its word table serves the worker's later tasks too."""
    return PieceModel(proto)


def _common_prefix(a: str, b: str) -> int:
    size = min(len(a), len(b))
    for k in range(size):
        if a[k] != b[k]:
            return k
    return size


def encode_documents(
    docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """The rows with ``ids``, an array of int, and with the text that they stand for if ``decoded``
    names a column for it. The model file is read on the driver."""
    model = _shared(docs, model_path)
    docs = docs.select(*(f"`{name}`" for name in without(docs.columns, ids, decoded)))
    place = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))])
    if decoded is not None:
        schema.add(decoded, StringType())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model.value)
        encode = pieces.encoder()
        for batch in batches:
            for part in _slices(batch, place):
                found = encode(part.column(place).to_pylist())
                columns = [*part.columns, _lists(found)]
                if decoded is not None:
                    columns.append(pa.array(
                        [None if x is None else pieces.decode(x) for x in found], pa.string()
                    ))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return small_batches(docs).mapInArrow(coded, schema)


def _slices(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with about SLICE_BYTES of text each, to hold few words at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES, prepend=0)).tolist()
    for start, end in pairwise(sorted({0, *cuts, len(sizes)})):
        yield batch.slice(start, end - start)


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    """Arrays of int32, or nulls, as one Arrow list column."""
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in arrays)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *(x for x in arrays if x is not None)])
    nulls = pa.array([x is None for x in arrays], pa.bool_())
    return pa.ListArray.from_arrays(ends, pa.array(values, pa.int32()), mask=nulls)


def decode_documents(
    rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """The rows with the text that their ids stand for."""
    model = _shared(rows, model_path)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = piece_model(model.value)
        for batch in batches:
            yield pd.Series([None if x is None else pieces.decode(x) for x in batch], dtype=object)

    return small_batches(rows).withColumn(text, decoded(F.col(f"`{ids}`")))


def _shared(frame: DataFrame, model_path: str):
    """The vocabulary file as a broadcast: its size does not depend on the data."""
    with open(model_path, "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())
