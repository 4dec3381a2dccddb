"""Export projections and retention bounds."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import epoch_ms, ts_literal
from candlewick.functions.symbols import market_code
from candlewick.functions.times import by_unit_sql
from candlewick.units import UNITS, lookback_start, to_epoch_ms


def to_export(candles: DataFrame) -> DataFrame:
    """Compact export rows of candles: unit name, market code, epoch ms."""
    return candles.select(
        F.expr(by_unit_sql("unit", lambda name: f"'{UNITS[name].export_name}'")).alias("unit"),
        F.upper("exchange").alias("market"),
        market_code(F.col("exchange"), F.col("symbol")).alias("code"),
        epoch_ms("timestamp").alias("tms"),
        F.col("open").alias("op"), F.col("high").alias("hp"), F.col("low").alias("lp"),
        F.col("close").alias("cp"), F.col("volume").alias("tv"),
    )


def latest_buckets(candles: DataFrame, now: datetime) -> DataFrame:
    """Candles of the previous and current bucket of their unit."""
    bounds = [
        (F.col("unit") == name) & (F.col("timestamp") >= ts_literal(lookback_start(now, name)))
        for name in UNITS
    ]
    return candles.where(reduce(Column.__or__, bounds))


def retention_cutoffs(now: datetime) -> dict[str, int]:
    """Oldest epoch ms kept per export unit; units kept for ever are absent."""
    now_ms = to_epoch_ms(now)
    return {
        unit.export_name: now_ms - unit.ms * unit.export_keep
        for unit in UNITS.values()
        if unit.export_keep is not None
    }


def is_expired(now: datetime) -> Column:
    """True for export rows older than their unit keeps."""
    bounds = [
        (F.col("unit") == unit) & (F.col("tms") < cutoff)
        for unit, cutoff in retention_cutoffs(now).items()
    ]
    return reduce(Column.__or__, bounds)
