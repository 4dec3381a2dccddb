"""Reconciliation by digests: only blocks of candles that differ are joined.

A block is one series over a day (units below an hour), a month (below a day) or a year. Every candle
is hashed, hashes are added up for each block, those of the exchange with a minus sign, in one hash
aggregate with map-side combine. Equal sides cancel out, so a block whose sums and counts are zero needs no
join: its candles enter the summary as counts. Of two copies that mostly agree, whole histories
are compared while little more than a row for each block is shuffled.

Sums of two 64-bit hashes, in halves so that they never overflow, tell blocks apart; unlike bits that are
XORed, repeated rows do not cancel each other. Candles that differ by no more than the tolerance of volumes make
a block differ too; whether that is a difference is decided by the pair. Null values are hashed as such.
Candles with a null in their key equal no other, so their blocks count as differing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.times import by_unit_sql
from candlewick.operators.compare import created_lag, paired, summary_rows, with_flags
from candlewick.schemas import CANDLE_KEYS, OHLCV, SERIES
from candlewick.units import DAY_MS, HOUR_MS, UNITS

BLOCK = "block"
SUMS = ["low_1", "high_1", "low_2", "high_2"]


def block_sql(unit: str) -> str:
    if UNITS[unit].ms < HOUR_MS:
        return "CAST(timestamp AS DATE)"
    return f"trunc(CAST(timestamp AS DATE), '{'MONTH' if UNITS[unit].ms < DAY_MS else 'YEAR'}')"


def with_block(candles: DataFrame) -> DataFrame:
    return candles.withColumn(BLOCK, F.expr(by_unit_sql("unit", block_sql)))


def digest_terms(sign: int) -> list[Column]:
    """Two 64-bit hashes of a candle as four signed halves."""
    # Hashing passes over nulls, so values would move up into their place.
    values = [v for c in OHLCV for v in (F.col(c), F.col(c).isNull())]
    terms = []
    for k in (1, 2):
        whole = F.xxhash64(F.lit(k), *CANDLE_KEYS, *values)
        terms += [whole.bitwiseAND(F.lit(0xFFFFFFFF)) * sign, F.shiftrightunsigned(whole, 32) * sign]
    return [term.alias(name) for term, name in zip(terms, SUMS)]


def compared_blocks(stored: DataFrame, served: DataFrame) -> DataFrame:
    """One row per block with the counts of both sides, late candles and whether the sides differ."""
    late = F.lit(False)
    if "created_at" in stored.columns:
        late = created_lag(F.col("created_at"), F.col("timestamp"))
    keys = [*SERIES, BLOCK]
    sides = [
        with_block(stored).select(
            *keys, F.lit(1).alias("db"), F.lit(0).alias("ex"), late.alias("late"), *digest_terms(1)),
        with_block(served).select(
            *keys, F.lit(0).alias("db"), F.lit(1).alias("ex"), F.lit(False).alias("late"), *digest_terms(-1)),
    ]
    blocks = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.sum("db").alias("db_count"), F.sum("ex").alias("exchange_count"),
        F.count_if("late").alias("created_at_diff_count"), *[F.sum(c).alias(c) for c in SUMS],
    )
    differs = F.col("db_count") != F.col("exchange_count")
    for name in SUMS:
        differs = differs | (F.col(name) != 0)
    for name in keys:
        differs = differs | F.col(name).isNull()
    return blocks.withColumn("differs", differs).drop(*SUMS)


def of_differing(candles: DataFrame, blocks: DataFrame) -> DataFrame:
    """The candles of blocks that differ."""
    found = blocks.where("differs").select(*SERIES, BLOCK)
    mine = with_block(candles)
    same = [mine[c].eqNullSafe(found[c]) for c in (*SERIES, BLOCK)]
    return mine.join(found, same, "left_semi").drop(BLOCK)


def flagged_pairs(stored: DataFrame, served: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of the candles of differing blocks, flagged; all others are equal."""
    return with_flags(paired(of_differing(stored, blocks), of_differing(served, blocks), "full_outer"))


def summary_by_digest(
    pairs: DataFrame, blocks: DataFrame, depth: int | dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """The summary of ``reconcile_summary`` from pairs of differing blocks and counts of the others."""
    return summary_rows(pairs, depth, blocks.where("NOT differs"))
