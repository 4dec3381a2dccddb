"""Candles to longer candles (A3-A6) and the cascade over the catalogue."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import bucket_start, exact_sum, from_epoch_ms, ts_literal
from candlewick.functions.times import epoch_ms_sql, floored_sql
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.units import DERIVED_UNITS, cascade_levels, lookback_start, to_epoch_ms


def rolled_ohlcv() -> list[Column]:
    """Base candles have distinct timestamps per series, so a plain time order decides.

    Every buffer is a primitive: the whole rollup stays in a hash aggregate with map-side
    combine.
    """
    return [
        F.expr("min_by(open, timestamp) AS open"),
        F.expr("max(high) AS high"),
        F.expr("min(low) AS low"),
        F.expr("max_by(close, timestamp) AS close"),
        exact_sum("volume").alias("volume"),
    ]


def rollup(candles: DataFrame, unit: str, timezone: str = "UTC") -> DataFrame:
    """All candles of one base unit to ``unit``; empty buckets stay absent."""
    return (
        candles.withColumn("bucket", bucket_start("timestamp", unit, timezone))
        .groupBy("exchange", "symbol", "bucket")
        .agg(*rolled_ohlcv())
        .withColumns({"unit": F.lit(unit), "timestamp": F.col("bucket")})
        .select(*CANDLE_COLUMNS)
    )


def since(candles: DataFrame, start: datetime) -> DataFrame:
    return candles.where(F.col("timestamp") >= ts_literal(start))


def rollup_latest(
    candles: DataFrame, unit: str, now: datetime, timezone: str = "UTC"
) -> DataFrame:
    """Previous and current bucket only; both are whole because the bound is aligned."""
    return rollup(since(candles, lookback_start(now, unit, timezone)), unit, timezone)


def rollup_range(
    candles: DataFrame, unit: str, start: datetime, end: datetime
) -> DataFrame:
    """One candle per symbol over ``start <= timestamp < end``, stamped with ``start``."""
    first, last = ts_literal(start), ts_literal(end)
    return (
        candles.where((F.col("timestamp") >= first) & (F.col("timestamp") < last))
        .groupBy("exchange", "symbol")
        .agg(*rolled_ohlcv())
        .withColumns({"unit": F.lit(unit), "timestamp": first})
        .select(*CANDLE_COLUMNS)
    )


def rollup_many(
    candles: DataFrame,
    units: list[str],
    timezone: str = "UTC",
    starts: dict[str, datetime] | None = None,
) -> DataFrame:
    """Several units from one base in one scan and one shuffle.

    Each base row is emitted once per unit and combined map-side, so what is shuffled is
    bounded by the output, not by rows times units. ``starts`` bounds single units.
    """
    ms = epoch_ms_sql("timestamp")
    targets = ", ".join(
        f"named_struct('unit', '{unit}', 'bucket', {floored_sql(ms, unit, timezone)})"
        for unit in units
    )
    rows = candles.select(
        "exchange", "symbol", "timestamp", "open", "high", "low", "close", "volume",
        F.expr(f"inline(array({targets}))"),
    )
    if starts:
        rows = rows.where(" OR ".join(
            f"(unit = '{unit}' AND bucket >= {to_epoch_ms(start)}L)"
            for unit, start in starts.items()
        ))
    return (
        rows.groupBy("bucket", "unit", "symbol", "exchange")
        .agg(*rolled_ohlcv())
        .withColumn("timestamp", from_epoch_ms("bucket"))
        .select(*CANDLE_COLUMNS)
    )


def rollup_all(candles: DataFrame, timezone: str = "UTC") -> DataFrame:
    """Every derived unit straight from 1m candles.

    Nested buckets make this equal to the level-by-level cascade, without its barriers.
    """
    return rollup_many(candles, DERIVED_UNITS, timezone)


# What each step of the nested rollup reads, and what it adds.
NESTED_STEPS = [
    ("1m", ["3m", "5m"]),
    ("5m", ["10m", "15m", "30m", "1h"]),
    ("1h", ["4h", "1d", "1w"]),
]


def rollup_nested(candles: DataFrame, timezone: str = "UTC") -> DataFrame:
    """Every derived unit in one shuffle, each from a shorter unit.

    1m candles are shuffled once, by series and week. Buckets of all units lie within a week, so each
    step groups inside its partition. A row is copied for the units of one step only, which handles less
    than half the rows that ``rollup_many`` does; and of 1m candles in no order, which combine little before a
    shuffle, each is sent once, not once per unit. A partition key holds a week of one series at most.
    """
    ms = epoch_ms_sql("timestamp")
    within = ["week", "symbol", "exchange"]
    rows = candles.select(
        "exchange", "symbol", "timestamp", "open", "high", "low", "close", "volume", F.lit("1m").alias("unit"),
        F.expr(floored_sql(ms, "1w", timezone)).alias("week"),
    ).repartition(*within)
    for base, units in NESTED_STEPS:
        kept = "" if base == "1m" else f"named_struct('unit', unit, 'bucket', {ms})"
        added = ", ".join(
            f"named_struct('unit', '{unit}', 'bucket', {floored_sql(ms, unit, timezone)})" for unit in units
        )
        targets = f"array({kept + ', ' if kept else ''}{added})"
        if kept:
            targets = f"IF(unit = '{base}', {targets}, array({kept}))"
        rows = (
            rows.select(*within, "timestamp", "open", "high", "low", "close", "volume",
                        F.expr(f"inline({targets})").alias("to", "bucket"))
            .groupBy(*within, "to", "bucket")
            .agg(*rolled_ohlcv())
            .withColumns({"unit": F.col("to"), "timestamp": from_epoch_ms("bucket")})
        )
    return rows.select(*CANDLE_COLUMNS)


def rollup_cascade(
    candles: DataFrame,
    timezone: str = "UTC",
    bases: dict[str, str] | None = None,
    native: frozenset[str] = frozenset(),
) -> DataFrame:
    """Level by level, each level from the one below, as the stored cascade computes it.

    ``native`` units are taken from ``candles`` as they are and never derived, except 1d,
    whose native candles follow another calendar.
    """
    stored = {"1m", *(native - {"1d"})}
    done = {unit: candles.where(F.col("unit") == unit) for unit in stored}
    derived = []
    for base, units in cascade_levels(bases):
        units = [unit for unit in units if unit not in stored]
        if not units:
            continue
        level = rollup_many(done[base], units, timezone)
        done |= {unit: level.where(F.col("unit") == unit) for unit in units}
        derived.append(level)
    return reduce(DataFrame.unionByName, derived)
