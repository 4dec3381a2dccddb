"""Reconciliation of candles against an independent source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import epoch_ms, from_epoch_ms, is_aligned, to_fixed
from candlewick.functions.numbers import as_mark
from candlewick.operators.series import (
    depth_of,
    drop_newest,
    drop_unclosed,
    newest_by_depth,
    newest_n,
)
from candlewick.schemas import CANDLE_KEYS, OHLCV, SERIES

# Volume differences below this are noise; candles may be created this late.
VOLUME_TOLERANCE = 0.1
CREATED_LAG_MS = 61_000


def created_lag(created_at: Column, timestamp: Column) -> Column:
    """True when a candle was first stored too far from its own start."""
    known = created_at.isNotNull() & (F.year(created_at) != 1970)
    zoned = (at.cast("timestamp") for at in (timestamp, created_at))
    start_ms, created_ms = (F.unix_millis(at) for at in zoned)
    return F.coalesce(known & (F.abs(start_ms - created_ms) > CREATED_LAG_MS), F.lit(False))


def with_created_lag(candles: DataFrame) -> DataFrame:
    return candles.withColumn(
        "created_diff", created_lag(F.col("created_at"), F.col("timestamp"))
    )


def paired(stored: DataFrame, exchange: DataFrame, how: str) -> DataFrame:
    """Both sides of each candle key as structs; a null struct is a missing side."""
    left = exchange.select(*CANDLE_KEYS, F.struct("timestamp", *OHLCV).alias("exchange_candle"))
    kept = ["timestamp", *OHLCV] + (["created_at"] if "created_at" in stored.columns else [])
    right = stored.select(*CANDLE_KEYS, F.struct(*kept).alias("db_candle"))
    return left.join(right, CANDLE_KEYS, how)


def with_flags(pairs: DataFrame) -> DataFrame:
    """Per-field flags; null where one side is missing."""
    db, ex = F.col("db_candle"), F.col("exchange_candle")
    differs = {f"{c}_diff": db[c] != ex[c] for c in ("open", "high", "low", "close")}
    pairs = pairs.withColumns(
        {**differs, "volume_delta": to_fixed(F.abs(db["volume"] - ex["volume"]), 4)}
    ).withColumn("volume_diff", F.col("volume_delta") >= VOLUME_TOLERANCE)
    any_flag = F.col("volume_diff")
    for name in differs:
        any_flag = any_flag | F.col(name)
    is_gap = ex.isNotNull() & db.isNull()
    return pairs.withColumns({
        "is_gap": is_gap,
        "is_diff": is_gap | F.coalesce(any_flag, F.lit(False)),
    })


def closed_on_grid(exchange: DataFrame, ranked: bool = False) -> DataFrame:
    """Exchange candles on their grid, without the one still open.

    ``ranked`` candles (``to_depth``) are already gathered by series, so the newest is ranked
    away; otherwise a small join finds it and the candles stay where they are.
    """
    aligned = exchange.where(is_aligned("timestamp"))
    return drop_newest(aligned) if ranked else drop_unclosed(aligned)


def reconcile_diffs(stored: DataFrame, served: DataFrame) -> DataFrame:
    """Closed exchange candles that are missing from the store or differ from it."""
    return diff_rows(with_flags(paired(stored, served, "left")))


def diff_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_diff").select(
        "exchange", "unit", "symbol",
        epoch_ms("timestamp").alias("tms"), F.col("timestamp").alias("date"),
        "db_candle", "exchange_candle",
        F.col("open_diff").alias("open"), F.col("high_diff").alias("high"),
        F.col("low_diff").alias("low"), F.col("close_diff").alias("close"),
        F.col("volume_diff").alias("volume"), "volume_delta",
        F.when(~F.col("is_gap"), F.lit(True)).alias("summary"),
    )


def reconcile_summary(
    stored: DataFrame, served: DataFrame, depth: int | dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """One row per series that has a difference or a late candle.

    A full outer join sees both sides once, so stored counts need no second pass.
    ``depth`` adds the depth that was compared as ``check_count``.
    """
    return summary_rows(with_flags(paired(stored, served, "full_outer")), depth)


def summary_rows(
    flagged: DataFrame, depth: int | dict[str, dict[str, int]] | None = None, equal: DataFrame | None = None
) -> DataFrame:
    """``equal`` has counts of candles that are equal on both sides and not among the pairs."""
    db, ex = F.col("db_candle"), F.col("exchange_candle")
    diff, late = F.col("is_diff"), F.lit(False)
    if "created_at" in flagged.schema["db_candle"].dataType.names:
        late = created_lag(db["created_at"], db["timestamp"])

    def flagged_count(name: str) -> Column:
        return F.count_if(diff & F.col(name))

    summary = flagged.groupBy(*SERIES).agg(
        F.count_if(db.isNotNull()).alias("db_count"),
        F.count_if(ex.isNotNull()).alias("exchange_count"),
        F.count_if(diff).alias("diff_count"),
        flagged_count("open_diff").alias("open_diff_count"),
        flagged_count("high_diff").alias("high_diff_count"),
        flagged_count("low_diff").alias("low_diff_count"),
        flagged_count("close_diff").alias("close_diff_count"),
        flagged_count("volume_diff").alias("volume_diff_count"),
        F.count_if(F.col("is_gap")).alias("gap_count"),
        F.count_if(late).alias("created_at_diff_count"),
        F.max(F.when(diff, F.col("volume_delta"))).alias("max_volume_diff"),
    )
    if equal is not None:
        counts = [c for c in summary.columns if c not in (*SERIES, "max_volume_diff")]
        summary = summary.unionByName(equal.select(*SERIES, *[
            F.col(c) if c in equal.columns else F.lit(0).alias(c) for c in counts
        ]), allowMissingColumns=True).groupBy(*SERIES).agg(
            *[F.sum(c).alias(c) for c in counts], F.max("max_volume_diff").alias("max_volume_diff")
        )
    summary = summary.where((F.col("diff_count") > 0) | (F.col("created_at_diff_count") > 0))
    if depth is None:
        return summary
    return summary.withColumn("check_count", depth_of(depth))


def to_depth(
    candles: DataFrame, depth: int | dict[str, dict[str, int]]
) -> DataFrame:
    """Newest candles per series, to one depth or to one per (exchange, unit)."""
    if isinstance(depth, int):
        return newest_n(candles, depth)
    return newest_by_depth(candles, depth).drop("check_count")


EXPORT_KEYS = ["unit", "market", "code", "tms"]


def export_flags(exported: DataFrame, rest: DataFrame, how: str = "inner") -> DataFrame:
    """Exported candles flagged against the REST candle of the same start.

    Rows without a counterpart are skipped; a left join keeps them, unflagged.
    """
    values = ["op", "hp", "lp", "cp", "tv"]
    theirs = rest.select(*EXPORT_KEYS, *[F.col(c).alias(f"rest_{c}") for c in values])
    prices = {"open": "op", "high": "hp", "low": "lp", "close": "cp"}
    differs = {
        flag: F.coalesce(F.col(c) != F.col(f"rest_{c}"), F.lit(False)) for flag, c in prices.items()
    }
    volume = to_fixed(F.col("tv"), 4) != to_fixed(F.col("rest_tv"), 4)
    return (
        exported.join(theirs, EXPORT_KEYS, how)
        .withColumns({**differs, "volume": F.coalesce(volume, F.lit(False))})
        .withColumns({
            "volume_diff": F.expr("CASE WHEN volume THEN abs(tv - rest_tv) ELSE 0D END"),
            "is_price": F.expr("open OR high OR low OR close"),
            "is_volume": F.col("volume"),
            "is_diff": F.expr("open OR high OR low OR close OR volume"),
        })
    )


def export_diff_rows(flagged: DataFrame) -> DataFrame:
    marks = [as_mark(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    return flagged.where("is_diff").select(
        "unit", "code", from_epoch_ms("tms").alias("date"), "tms", *marks,
        "is_price", "is_volume", "volume_diff",
    )


def export_summary(
    exported: DataFrame, rest: DataFrame, check_count: int = 1000
) -> DataFrame:
    """One row per exported (code, unit), also where nothing differs.

    Of equal largest differences the newest counts, as rows are read newest first.
    """
    counted = export_flags(exported, rest, "left").groupBy("code", "unit").agg(
        F.count_if("is_diff").alias("diff_count"),
        F.count_if("is_price").alias("price_diff_count"),
        F.count_if("is_volume").alias("volume_diff_count"),
        F.expr("max(struct(volume_diff, tms)) FILTER (WHERE volume_diff > 0)").alias("largest"),
    )
    largest = F.coalesce(F.col("largest.volume_diff"), F.lit(0.0))
    return counted.select(
        "code",
        F.lower("unit").alias("candle"),
        "diff_count",
        to_fixed(F.col("diff_count") / F.lit(check_count) * 100, 2).alias("diff_percent"),
        "price_diff_count",
        "volume_diff_count",
        to_fixed(largest, 2).alias("max_volume_diff"),
        from_epoch_ms("largest.tms").alias("max_volume_diff_date"),
    )
