"""Landed candle history to candles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions import from_epoch_ms, is_aligned
from candlewick.functions.symbols import code_to_symbol
from candlewick.functions.times import unit_bucket_start
from candlewick.operators.series import newest_n
from candlewick.schemas import CANDLE_KEYS, OHLCV
from candlewick.units import UNITS


def candles_from_arrays(rows: DataFrame) -> DataFrame:
    """Positional ``[tms, open, high, low, close, volume]`` rows to named candles.

    Units outside the catalogue (months) have no table and drop.
    """
    values = [F.col("ohlcv")[i].alias(name) for i, name in enumerate(OHLCV, start=1)]
    return rows.where(F.col("unit").isin(*UNITS)).select(
        "exchange", "unit", from_epoch_ms("CAST(ohlcv[0] AS BIGINT)").alias("timestamp"), "symbol", *values
    )


def newest_page(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping pages to one row per key: the last page that holds a key wins."""
    rest = [c for c in pages.columns if c not in (*keys, "page")]
    return pages.groupBy(*keys).agg(*[F.max_by(c, "page").alias(c) for c in rest])


def history_from_pages(pages: DataFrame, since: int = 0, limit: int = 2000) -> DataFrame:
    """Candle pages (with ``page``) to rows ``since < rank <= limit`` per series, newest first."""
    return newest_n(newest_page(pages, CANDLE_KEYS), limit, skip=since)


def native_history(rows: DataFrame) -> DataFrame:
    """Served candles that lie on their grid, snapped to their bucket start.

    Of several in one bucket the latest served counts. 1d is skipped: its served day follows
    another calendar and is derived instead.
    """
    candles = candles_from_arrays(rows).where(F.col("unit") != "1d")
    aligned = candles.where(is_aligned("timestamp")).withColumn(
        "bucket", unit_bucket_start("timestamp")
    )
    # Equal times would make one max_by per column mix rows; a struct takes one row whole.
    last = F.max(F.struct("timestamp", *OHLCV)).alias("last")
    return aligned.groupBy("exchange", "unit", "bucket", "symbol").agg(last).select(
        "exchange", "unit", F.col("bucket").alias("timestamp"), "symbol",
        *[F.col(f"last.{c}").alias(c) for c in OHLCV],
    )


def misaligned_history(rows: DataFrame) -> DataFrame:
    """The served candles that ``native_history`` leaves out, for inspection."""
    candles = candles_from_arrays(rows).where(F.col("unit") != "1d")
    return candles.where(~is_aligned("timestamp"))


def rest_to_export(rows: DataFrame, exchange: str = "upbit") -> DataFrame:
    """REST candle objects as export rows, one per (unit, code, tms); later pages win."""
    at = F.try_to_timestamp("candle_date_time_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    named = rows.select(
        "unit", F.lit(exchange.upper()).alias("market"), F.col("market").alias("code"),
        F.unix_millis(at).alias("tms"),
        F.col("opening_price").alias("op"), F.col("high_price").alias("hp"),
        F.col("low_price").alias("lp"), F.col("trade_price").alias("cp"),
        F.col("candle_acc_trade_volume").alias("tv"), "page",
    )
    return newest_page(named, ["unit", "market", "code", "tms"])


def rest_to_candles(rows: DataFrame, exchange: str = "upbit") -> DataFrame:
    """REST candle objects as candles; ``unit`` holds the catalogue name here."""
    named = rest_to_export(rows, exchange)
    return named.select(
        F.lit(exchange).alias("exchange"), "unit", from_epoch_ms("tms").alias("timestamp"),
        code_to_symbol(exchange, F.col("code")).alias("symbol"),
        F.col("op").alias("open"), F.col("hp").alias("high"), F.col("lp").alias("low"),
        F.col("cp").alias("close"), F.col("tv").alias("volume"),
    )
