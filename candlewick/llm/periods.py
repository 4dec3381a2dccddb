"""Periodic runs of words, by seed and extend along diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
of at least max(MIN_WORDS, MIN_PERIODS * q) words that no neighbouring word extends.

Two words ``q`` apart lie on the diagonal of lag ``q``, and a run is a stretch of equal pairs on it
of at least 3 q words (five if q is 1). So for lags up to three times ``low`` every run holds a
k-gram of ``k = 3 * low`` words twice, at distance ``q``. As ``k`` is no less than the lag, no third
copy lies between the two: it would give the stretch a smaller period. Each level of lags therefore
indexes its k-grams and takes only neighbouring occurrences as seeds, one per place at most, and
misses no run. Seeds are extended both ways; a table of the furthest place covered on each lag
drops seeds that lie in a stretch already extended. Whatever a seed's hash says, extension compares
the words themselves.

A text takes memory in proportion to its words, and time in proportion to n log n of them.

Rows: a null or empty text has no runs and collapses to an empty text. Whole texts are read, however
long. Runs come by start, then period, so there are no ties; repeated rows get equal runs. The
columns ``runs`` and ``collapsed`` replace columns of the same name; others pass through. No rows
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from candlewick.llm.common import free_name, small_batches, without, word_runs

MIN_WORDS, MIN_PERIODS = 6, 4
RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
RESULT = StructType([StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
JOIN_WORDS = 1 << 16
_SEED_ODD = 0x9E3779B97F4A7C15


def words_of(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word in order of place, and the distinct words by number."""
    numbers: dict[bytes, int] = {}
    parts = []
    for run in word_runs(data):
        found = (numbers.setdefault(word, len(numbers)) for word in run)
        parts.append(np.fromiter(found, np.int64, len(run)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), list(numbers)


def levels(n: int) -> Iterator[tuple[int, int, int]]:
    """(least lag, greatest lag, k) for texts of n words: every lag up to n / MIN_PERIODS once."""
    low = 1
    while MIN_PERIODS * low <= n:
        # On lag q a run has at least max(MIN_WORDS - q, 3 q) equal pairs.
        k = min(max(MIN_WORDS - q, (MIN_PERIODS - 1) * q) for q in (low, low + 1))
        yield low, k, k
        low = k + 1


class GramHashes:
    """Hashes of all windows of k words, for growing k, from those of a power of two of words."""

    def __init__(self, words: np.ndarray) -> None:
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(_SEED_ODD)
        self.size, self.hashes = 1, mixed ^ (mixed >> np.uint64(29))

    @staticmethod
    def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        mixed = (left * np.uint64(0xBF58476D1CE4E5B9)) ^ (right + np.uint64(0x94D049BB133111EB))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_SEED_ODD)
        return mixed ^ (mixed >> np.uint64(30))

    def of(self, k: int) -> np.ndarray:
        """One hash for each place where a window of k words starts: two overlapping parts."""
        while 2 * self.size <= k:
            self.hashes = self._join(self.hashes[:-self.size], self.hashes[self.size:])
            self.size *= 2
        rest = k - self.size
        return self._join(self.hashes[:-rest], self.hashes[rest:]) if rest else self.hashes


def seeds(hashes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences of one k-gram, by place."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    first, lag = order[:-1][same], (order[1:] - order[:-1])[same]
    fits = (lag >= low) & (lag <= high)
    first, lag = first[fits], lag[fits]
    by_place = np.argsort(first, kind="stable")
    return first[by_place], lag[by_place]


def equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries are equal, looked at in blocks of growing size."""
    done, block, most = 0, 16, min(len(a), len(b))
    while done < most:
        differ = a[done:min(done + block, most)] != b[done:min(done + block, most)]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, block = done + len(differ), block * 2
    return most


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    grams, found = GramHashes(words), []
    for low, high, k in levels(len(words)):
        if len(words) < k + low:
            break
        covered: dict[int, int] = {}
        for place, lag in zip(*(x.tolist() for x in seeds(grams.of(k), low, high)), strict=True):
            reached = covered.get(lag, 0)
            if place < reached:
                continue
            # Behind ``reached`` lies a pair of this lag that differs.
            back = equal_ahead(words[reached:place][::-1], words[reached + lag:place + lag][::-1])
            ahead = equal_ahead(words[place:-lag], words[place + lag:])
            covered[lag] = place + ahead + 1
            length = back + ahead + lag
            if length >= max(MIN_WORDS, MIN_PERIODS * lag):
                found.append((place - back, length, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: np.ndarray, names: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, but for those of a run after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = words[np.cumsum(edges[:-1]) == 0].tolist()
    parts = (kept[k:k + JOIN_WORDS] for k in range(0, len(kept), JOIN_WORDS))
    return b" ".join(b" ".join(names[w] for w in part) for part in parts)


def describe(data: bytes | None) -> tuple[list[dict[str, int]], str]:
    """The runs of a text in UTF-8, and the text without its repetitions."""
    words, names = words_of(data or b"")
    runs = find_runs(words)
    named = [dict(zip(RUN.names, run, strict=True)) for run in runs]
    return named, collapse(words, names, runs).decode()


@F.pandas_udf(RESULT)
def _described(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([describe(x) for x in batch], columns=["runs", "collapsed"])


def with_runs(
    docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed",
) -> DataFrame:
    """The rows with every run of the text and the text without its repetitions."""
    both = free_name(docs, "_described")
    held = small_batches(docs).withColumn(both, _described(F.col(f"`{text}`").cast("binary")))
    return held.select(
        *(F.col(f"`{name}`") for name in without(docs.columns, runs, collapsed)),
        F.col(f"`{both}`.runs").alias(runs), F.col(f"`{both}`.collapsed").alias(collapsed),
    )
