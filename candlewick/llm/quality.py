"""Quality rules as a bitmask ledger.

Every rule is measured once for each text. The ledger keeps the measurements and one long whose
bits say which rules failed. Policies are masks over those bits, so a new policy or an ablation
reads the ledger and never the texts.

Rows: a null or empty text measures zero everywhere and fails the word count. Repeated rows get
equal entries. Very long texts are measured whole. Other columns of the table pass through, but one named
like the ledger is replaced by it; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.llm.common import free_name, small_batches, word_runs

WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
    "n_stutters",
)

_NOT_SYMBOL = bytes(set(range(256)) - set(SYMBOLS))
_NOT_CAPITAL = bytes(set(range(256)) - set(range(ord("A"), ord("Z") + 1)))
_NOT_WORD_START = bytes([*range(0x80, 0xC0), *b" \t\n\v\f\r"])
_MULTIPLIERS = np.array(
    [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW_WORDS)], dtype=np.uint64
)


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measures; the bit is the rule's place in the ledger for ever."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "capitals", "100 * n_capitals > 40 * word_chars"),
    Rule(7, "stutters", "100 * n_stutters > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules. A text is kept if it fails none of them."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {rule.name: rule.bit for rule in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("strict", 1, tuple(rule.name for rule in RULES))


def repeated_window_words(words: np.ndarray) -> int:
    """Words that lie in an 8-word window found twice or more, the first finding included.

    ``words`` holds a 64-bit hash for each word. Windows are equal if their hashes are.
    """
    windows = len(words) - WINDOW_WORDS + 1
    if windows < 2:
        return 0
    hashes = np.zeros(windows, dtype=np.uint64)
    for k, multiplier in enumerate(_MULTIPLIERS):
        hashes += words[k:k + windows] * multiplier
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    found = np.zeros(windows, dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(found)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW_WORDS, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure_text(data: bytes | None) -> tuple[int, ...]:
    """The values of MEASURES for one text in UTF-8."""
    data = data or b""
    runs = [np.fromiter(map(hash, run), np.int64, len(run)) for run in word_runs(data)]
    words = np.concatenate(runs).view(np.uint64) if runs else np.zeros(0, np.uint64)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(data.translate(None, _NOT_WORD_START)),
        len(data.translate(None, _NOT_SYMBOL)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(data.translate(None, _NOT_CAPITAL)),
        int(np.count_nonzero(words[1:] == words[:-1])),
    )


@F.pandas_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def _measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = [measure_text(data) for data in batch]
        yield pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(MEASURES)), columns=MEASURES)


def failure_bits(measure: str) -> Column:
    """The failed rules as bits of a long; ``measure`` is the struct of measurements."""
    flags = [
        F.when(F.expr(_over(rule.failed, measure)), F.lit(1 << rule.bit)).otherwise(F.lit(0))
        for rule in RULES
    ]
    bits = flags[0].cast("long")
    for flag in flags[1:]:
        bits = bits.bitwiseOR(flag.cast("long"))
    return bits


def _over(sql: str, struct: str) -> str:
    return " ".join(f"`{struct}`.{w}" if w in MEASURES else w for w in sql.split())


def with_ledger(docs: DataFrame, text: str = "text", ledger: str = "ledger") -> DataFrame:
    """The rows with a struct ``ledger``: every measurement and ``failed``, the rule bits."""
    raw = free_name(docs, "_measures")
    measured = small_batches(docs).withColumn(raw, _measures(F.col(f"`{text}`").cast("binary")))
    fields = [F.col(f"`{raw}`.{name}").alias(name) for name in MEASURES]
    entry = F.struct(*fields, failure_bits(raw).alias("failed"))
    return measured.withColumn(ledger, entry).drop(raw)


def passes(policy: Policy, bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def filter_documents(docs: DataFrame, policy: Policy = STRICT, text: str = "text") -> DataFrame:
    """The rows whose text the policy keeps, with their own columns."""
    ledger = free_name(docs, "_ledger")
    judged = with_ledger(docs, text, ledger)
    return judged.where(passes(policy, F.col(f"`{ledger}`.failed"))).drop(ledger)


def ablations(bits: DataFrame, policy: Policy, column: str = "failed") -> DataFrame:
    """Per rule of the policy: texts failing it, and texts that only it rejects.

    Texts are counted per bit pattern first, so what is compared with the rules has at most two
    to the number of rules rows.
    """
    patterns = bits.groupBy(F.col(f"`{column}`").alias("bits")).agg(F.count("*").alias("n"))
    masks = [(r.name, 1 << r.bit) for r in RULES if r.name in policy.rules]
    each = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(mask).alias("rule_bit")) for name, mask in masks
    )))
    seen = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("rule_bit")) != 0
    alone = F.col("bits").bitwiseAND(F.lit(policy.mask)) == F.col("rule_bit")
    return seen.groupBy("rule").agg(
        F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"),
        F.sum("n").alias("n_docs"),
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only_this"),
    )
