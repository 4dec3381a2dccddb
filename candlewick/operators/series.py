"""Serving queries over candle series.

A series is one (exchange, unit, symbol). Its candles have distinct bucket starts, so its
row count is bounded by elapsed time over unit length, however many trades it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.functions import epoch_ms
from candlewick.functions.times import epoch_ms_sql, unit_ms_sql
from candlewick.schemas import SERIES

# Candles of a series are checked for gaps in chunks of this many unit lengths.
GAP_CHUNK = 10_000


def latest_per_series(candles: DataFrame) -> DataFrame:
    """Newest candle of each series; primitive buffers keep it in a hash aggregate."""
    values = [c for c in candles.columns if c not in (*SERIES, "timestamp")]
    return candles.groupBy(*SERIES).agg(
        F.max("timestamp").alias("timestamp"),
        *[F.max_by(c, "timestamp").alias(c) for c in values],
    )


def newest_n(
    candles: DataFrame, n: int, skip: int = 0,
    series: Sequence[str] = SERIES, time: str = "timestamp",
) -> DataFrame:
    """Rows ``skip < rank <= n`` of each series, newest first.

    Spark keeps only ``n`` rows per series and task before the shuffle (WindowGroupLimit).
    """
    newest_first = Window.partitionBy(*series).orderBy(F.desc(time))
    ranked = candles.withColumn("rn", F.row_number().over(newest_first)).where(F.col("rn") <= n)
    return (ranked.where(F.col("rn") > skip) if skip else ranked).drop("rn")


def depth_of(depths: int | dict[str, dict[str, int]]) -> Column:
    """Rows to compare per series: one number, or one per (exchange, unit)."""
    if isinstance(depths, int):
        return F.lit(depths)
    branches = " ".join(
        f"WHEN exchange = '{exchange}' AND unit = '{unit}' THEN {rows}"
        for exchange, by_unit in depths.items() for unit, rows in by_unit.items()
    )
    return F.expr(f"CASE {branches} END")


def newest_by_depth(candles: DataFrame, depths: dict[str, dict[str, int]]) -> DataFrame:
    """Newest rows of each series to the depth its (exchange, unit) asks for; others drop."""
    deepest = max(rows for by_unit in depths.values() for rows in by_unit.values())
    newest_first = Window.partitionBy(*SERIES).orderBy(F.desc("timestamp"))
    return (
        candles.withColumn("check_count", depth_of(depths))
        .where(F.col("check_count").isNotNull())
        .withColumn("rn", F.row_number().over(newest_first))
        .where(F.col("rn") <= deepest)
        .where(F.col("rn") <= F.col("check_count"))
        .drop("rn")
    )


def latest_starts(candles: DataFrame) -> DataFrame:
    return candles.groupBy(*SERIES).agg(F.max("timestamp").alias("latest"))


def with_closed(candles: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Adds ``closed``: the series already has a later candle.

    The newest start per series is one small row each and joins back; the candles
    themselves are neither shuffled nor sorted when it fits a broadcast.
    """
    newest = latest_starts(candles) if latest is None else latest
    return (
        candles.join(newest, SERIES)
        .withColumn("closed", F.col("timestamp") < F.col("latest"))
        .drop("latest")
    )


def drop_unclosed(candles: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """All but the newest candle of each series, for candles that are cheap to scan twice."""
    return with_closed(candles, latest).where("closed").drop("closed")


def drop_newest(candles: DataFrame) -> DataFrame:
    """As ``drop_unclosed``, for candles that are costly to compute twice or already
    partitioned by series."""
    newest_first = Window.partitionBy(*SERIES).orderBy(F.desc("timestamp"))
    ranked = candles.withColumn("rn", F.row_number().over(newest_first))
    return ranked.where(F.col("rn") > 1).drop("rn")


def gaps(candles: DataFrame) -> DataFrame:
    """Consecutive candles of a series whose starts are not exactly one unit apart.

    Steps are taken inside chunks of a series, so no task sorts a whole series; only the
    first and last row of each chunk meet again to bridge chunk borders.
    """
    rows = candles.select(
        *SERIES, "timestamp", F.expr(unit_ms_sql("unit")).alias("unit_ms")
    ).withColumn(
        "chunk", F.expr(f"{epoch_ms_sql('timestamp')} div (unit_ms * {GAP_CHUNK})")
    )
    in_chunk = Window.partitionBy(*SERIES, "chunk").orderBy("timestamp")
    stepped = rows.select(
        *SERIES, "unit_ms", "timestamp",
        F.lag("timestamp").over(in_chunk).alias("previous"),
        F.lead("timestamp").over(in_chunk).alias("following"),
    )
    edges = stepped.where(F.col("previous").isNull() | F.col("following").isNull())
    by_series = Window.partitionBy(*SERIES).orderBy("timestamp")
    bridged = edges.withColumn(
        "before", F.lag("timestamp").over(by_series)
    ).where(F.col("previous").isNull()).select(
        *SERIES, "unit_ms", "timestamp", F.col("before").alias("previous")
    )
    inside = stepped.select(*SERIES, "unit_ms", "timestamp", "previous")
    step = epoch_ms("timestamp") - epoch_ms("previous")
    return (
        inside.unionByName(bridged)
        .where(F.col("previous").isNotNull())
        .withColumn("step_ms", step)
        .where(F.col("step_ms") != F.col("unit_ms"))
        .select(*SERIES, "previous", "timestamp", "step_ms")
    )


def oldest_timestamp(candles: DataFrame) -> DataFrame:
    return candles.agg(F.min("timestamp").alias("timestamp"))


def symbols(candles: DataFrame) -> DataFrame:
    return candles.select("symbol").distinct().orderBy("symbol")


def codes(exports: DataFrame, market: str) -> DataFrame:
    return exports.where(F.col("market") == market).select("code").distinct()


def candles_by_symbol(
    candles: DataFrame, exchange: str, unit: str, symbol: str,
    since: int = 0, limit: int = 1000, ascending: bool = False,
) -> DataFrame:
    """One series by time, rows ``since`` to ``limit`` (an end index)."""
    order: Column = F.asc("timestamp") if ascending else F.desc("timestamp")
    columns = ["timestamp", "symbol", "open", "high", "low", "close", "volume"]
    if unit == "1m" and "created_at" in candles.columns:
        columns.append("created_at")
    picked = candles.where(
        (F.col("exchange") == exchange) & (F.col("unit") == unit) & (F.col("symbol") == symbol)
    )
    return picked.select(*columns).orderBy(order).offset(since).limit(max(limit - since, 0))
