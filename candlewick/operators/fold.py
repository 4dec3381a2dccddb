"""Trades to candles (A1, A2) and the merge of partial candles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import bucket_start, exact_sum
from candlewick.functions.numbers import MOST_VALUE
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.units import HOUR_MS, UNITS


@dataclass(frozen=True)
class Profile:
    """How an exchange orders trades that share a timestamp, and whether it repeats them."""

    name: str
    ties: tuple[str, ...]
    repeats: bool


SEQUENCE = Profile("sequence", ties=("id",), repeats=True)
ARRIVAL = Profile("arrival", ties=("arrival_seq", "arrival_pos"), repeats=False)
PROFILES = {"upbit": SEQUENCE, "bithumb": ARRIVAL}

# A stored candle that seeds a fold sorts before every trade of its first instant.
SEED_TIE = -(2**63)


def priced(trades: DataFrame) -> DataFrame:
    """Trades that can move a candle; malformed and absurd numbers stay in the trade store only."""
    # NaN is greater than any number.
    return trades.where(
        f"timestamp IS NOT NULL AND abs(price) < {MOST_VALUE}D AND abs(amount) < {MOST_VALUE}D"
    )


def first_of_each(trades: DataFrame, keys: list[str]) -> DataFrame:
    """One trade per key: the earliest, then cheapest, so that re-runs agree.

    The key includes the trade id, so the shuffle spreads even one symbol's single minute,
    and repeats of one id collapse before it.
    """
    rest = [c for c in trades.columns if c not in keys]
    order = [c for c in ("timestamp", "price", "amount") if c in rest]
    packed = F.struct(*order, *[c for c in rest if c not in order])
    return (
        trades.groupBy(*keys)
        .agg(F.min(packed).alias("first"))
        .select(*keys, *[F.col("first")[c].alias(c) for c in rest])
    )


def repeats_dropped(trades: DataFrame, distinct) -> DataFrame:
    """``distinct`` of the trades that have an id; trades without one cannot be repeats."""
    known = distinct(trades.where("id IS NOT NULL"))
    return known.unionByName(trades.where("id IS NULL"))


def trade_order(profile: Profile) -> Column:
    """What orders trades: (timestamp, tie, pos). Trades without id tie by hash of their values."""
    if profile.repeats:
        tie, pos = F.col("id"), F.when(F.col("id").isNull(), F.hash("price", "amount")).otherwise(0)
    else:
        # Without an order of arrival open and close would depend on the order of rows.
        missing = F.raise_error(F.lit("a trade has no order of arrival")).cast("long")
        tie = F.when(F.col("arrival_seq").isNotNull(), F.col("arrival_seq")).otherwise(missing)
        pos = F.coalesce("arrival_pos", F.lit(0))
    return F.struct("timestamp", tie.alias("tie"), pos.alias("pos"))


def as_states(trades: DataFrame, profile: Profile) -> DataFrame:
    """Each trade as a candle of its own, so trades and stored candles merge alike."""
    price, at = F.col("price"), trade_order(profile)
    passed = [c for c in ("exchange", "symbol", "timestamp", "bucket") if c in trades.columns]
    return trades.select(
        *passed,
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        F.col("amount").alias("volume"), at.alias("first_at"), at.alias("last_at"),
    )


def seed_states(candles: DataFrame) -> DataFrame:
    """Stored candles as states that keep their open and yield their close to any trade."""
    at = F.struct("timestamp", F.lit(SEED_TIE).alias("tie"), F.lit(0).alias("pos"))
    return candles.select(
        "exchange", "symbol", "timestamp", "open", "high", "low", "close", "volume",
        at.alias("first_at"), at.alias("last_at"),
    )


def merged_ohlcv() -> list[Column]:
    return [
        F.expr("min_by(open, first_at) AS open"),
        F.expr("max(high) AS high"),
        F.expr("min(low) AS low"),
        F.expr("max_by(close, last_at) AS close"),
        exact_sum("volume").alias("volume"),
    ]


def merge_states(states: DataFrame, unit: str = "1m", timezone: str = "UTC") -> DataFrame:
    """Candles from any mix of trades and stored candles of one unit."""
    return (
        states.withColumn("bucket", bucket_start("timestamp", unit, timezone))
        .groupBy("bucket", "symbol", "exchange")
        .agg(*merged_ohlcv())
        .select("exchange", F.lit(unit).alias("unit"), F.col("bucket").alias("timestamp"),
                "symbol", "open", "high", "low", "close", "volume")
    )


def fold_trades(
    trades: DataFrame,
    unit: str = "1m",
    profile: Profile = SEQUENCE,
    timezone: str = "UTC",
    details: bool = False,
    spread_ids: bool | None = None,
) -> DataFrame:
    """OHLCV candles per (exchange, symbol, bucket).

    Open and close follow (timestamp, tie), so the result does not depend on row order.
    Repeats are dropped per candle, as ids are only unique within their series. The bucket
    leads the group keys because the aggregate sorts on them and a long prefix compares
    without touching the symbol strings.

    Up to an hour trades are shuffled once, by candle, which serves repeats and candles alike.
    ``spread_ids`` shuffles them by id first, so that not even one candle's trades must fit one
    task; it is the default for longer units, where a hot symbol fills few candles.
    """
    if spread_ids is None:
        spread_ids = UNITS[unit].ms > HOUR_MS
    rows = priced(trades).select(
        "exchange", "symbol", bucket_start("timestamp", unit, timezone).alias("bucket"),
        "timestamp", "price", "amount", *profile.ties,
    )
    if profile.repeats:
        keys = ["id", "bucket", "symbol", "exchange"]
        if not spread_ids:
            rows = rows.repartition("bucket", "symbol", "exchange")
            keys = [*keys[1:], "id"]
        rows = repeats_dropped(rows, lambda known: first_of_each(known, keys))
    extra = []
    if details:
        extra = [
            F.min("timestamp").alias("first_trade"),
            F.max("timestamp").alias("last_trade"),
            F.max("last_at").alias("last_at"),
        ]
    states = as_states(rows, profile)
    candles = states.groupBy("bucket", "symbol", "exchange").agg(*merged_ohlcv(), *extra)
    columns = [
        F.lit(unit).alias(c) if c == "unit" else
        F.col("bucket").alias(c) if c == "timestamp" else F.col(c)
        for c in CANDLE_COLUMNS
    ]
    if details:
        columns += ["first_trade", "last_trade", F.col("last_at.tie").alias("last_tie")]
    return candles.select(*columns)
