"""The jobs a user runs. Each takes its clock as ``now`` and works on whole tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions import bucket_start, period_start, ts_literal
from candlewick.functions.times import epoch_ms_sql, floored_sql, from_epoch_ms_sql
from candlewick.operators.compare import (
    closed_on_grid,
    diff_rows,
    export_summary,
    to_depth,
)
from candlewick.operators.digest import compared_blocks, flagged_pairs, summary_by_digest
from candlewick.operators.export import latest_buckets, to_export
from candlewick.operators.fold import PROFILES, fold_trades, priced
from candlewick.operators.rollup import rollup_many, rollup_nested
from candlewick.operators.series import gaps, newest_n
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.session import shared_folder, use_utc
from candlewick.sources.history import candles_from_arrays, native_history
from candlewick.sources.reports import write_csv_summary, write_diff_report, write_summary_report
from candlewick.sources.tables import CandleTable, ExportTable
from candlewick.streaming.candles import LATENESS, candle_stream, seed_stream, upsert_stream
from candlewick.streaming.late import create_landing, in_time, landing_stream
from candlewick.units import UNITS, cascade_levels, covering_unit, from_epoch, lookback_start


def stream_candles(
    spark: SparkSession,
    trades: DataFrame,
    exchange: str,
    table: CandleTable,
    checkpoint: str,
    seed_path: str | None = None,
    every: str | None = "3 seconds",
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Keeps the 1m candles of a trade stream upserted.

    The first start continues the stored open candles, which it lands in ``seed_path`` (beside
    the checkpoint by default); later starts read the same seeds and the checkpoint.
    """
    use_utc(spark)
    seed_path = seed_path or f"{checkpoint.rstrip('/')}-seeds"
    seeds = seed_stream(table, exchange, seed_path, checkpoint)
    candles = candle_stream(trades, profile=PROFILES[exchange], seeds=seeds, lateness=lateness)
    return upsert_stream(candles, table, checkpoint, every=every)


def stream_candles_and_late(
    spark: SparkSession,
    trades: DataFrame,
    exchange: str,
    table: CandleTable,
    landing: str,
    checkpoint: str,
    every: str | None = "3 seconds",
    lateness: str = LATENESS,
) -> list[StreamingQuery]:
    """As ``stream_candles``, with all trades landed first and the late ones kept for ``repair``."""
    use_utc(spark)
    checkpoint = checkpoint.rstrip("/")
    create_landing(spark, landing)
    first = landing_stream(trades, landing, f"{checkpoint}-landing", lateness, every)
    if every is None:
        first.awaitTermination()
    second = stream_candles(
        spark, in_time(spark, landing), exchange, table, checkpoint, every=every, lateness=lateness
    )
    return [first, second]


def repair(
    table: CandleTable, late: DataFrame, trades: DataFrame, exchange: str, timezone: str = "UTC"
) -> None:
    """Recomputes the candles that late trades belong to, however old, and no others.

    ``trades`` holds all trades, late ones too; a column ``day`` prunes them. The minutes of the late
    trades are folded again; then each level up, the buckets that hold one of these minutes are rolled
    up again from the stored candles of the level below. What is collected are days and periods.
    """
    use_utc(table.spark)
    series = ["exchange", "symbol"]
    minutes = priced(late).select(*series, bucket_start("timestamp", "1m").alias("minute")).distinct().persist()
    if "day" in trades.columns:
        days = minutes.select(F.col("minute").cast("date").alias("day")).distinct()
        trades = trades.where(F.col("day").isin([row["day"] for row in days.collect()]))
    again = trades.withColumn("minute", bucket_start("timestamp", "1m")).join(
        minutes, [*series, "minute"], "left_semi"
    )
    table.upsert(fold_trades(again, profile=PROFILES[exchange]))
    for base, units in cascade_levels():
        wide = covering_unit(units)
        held = bucket_start("minute", wide, timezone)
        buckets = minutes.select(*series, held.alias("wide")).distinct().persist()
        last = F.col("wide") + F.expr(f"INTERVAL {UNITS[wide].ms // 1000 - 1} SECONDS")
        ends = buckets.select(F.explode(F.array("wide", last)).alias("at"))
        periods = [row["p"] for row in ends.select(period_start("at", base).alias("p")).distinct().collect()]
        rows = table.candles(units=[base], periods=periods)
        rolled = rollup_many(
            rows.withColumn("wide", bucket_start("timestamp", wide, timezone)).join(
                buckets, [*series, "wide"], "left_semi"
            ), units, timezone,
        )
        starts = F.explode(F.array(*(
            F.struct(F.lit(unit).alias("unit"), from_epoch_ms_of("minute", unit, timezone).alias("timestamp"))
            for unit in units
        )))
        changed = minutes.select(*series, starts.alias("c")).select(*series, "c.unit", "c.timestamp").distinct()
        table.upsert(rolled.join(changed, [*series, "unit", "timestamp"], "left_semi"))
        buckets.unpersist()
    minutes.unpersist()


def from_epoch_ms_of(at: str, unit: str, timezone: str) -> Column:
    return F.expr(from_epoch_ms_sql(floored_sql(epoch_ms_sql(at), unit, timezone)))


def load_trades(trades: DataFrame, exchange: str, table: CandleTable) -> None:
    """Folds a batch of landed trades into 1m candles."""
    use_utc(table.spark)
    table.upsert(fold_trades(trades, profile=PROFILES[exchange]))


def load_history(rows: DataFrame, table: CandleTable, native_grid: bool = False) -> None:
    """Upserts landed positional candles of all symbols and catalogue units.

    ``native_grid`` keeps only candles on their grid and leaves out served days.
    """
    use_utc(table.spark)
    table.upsert(native_history(rows) if native_grid else candles_from_arrays(rows))


def rollup_latest(table: CandleTable, now: datetime, timezone: str = "UTC") -> None:
    """Recomputes the previous and current bucket of every derived unit, all exchanges at once.

    Each base unit is read from the store back to the oldest bucket that needs it; what this run has
    derived itself replaces the stored rows, so all units are written at once.
    """
    use_utc(table.spark)
    fresh: dict[str, DataFrame] = {}
    levels = []
    for base, units in cascade_levels():
        starts = {unit: lookback_start(now, unit, timezone) for unit in units}
        rows = table.candles(units=[base], start=min(starts.values())).select(*CANDLE_COLUMNS)
        if base in fresh:
            rows = rows.where(F.col("timestamp") < ts_literal(lookback_start(now, base, timezone)))
            rows = rows.unionByName(fresh[base])
        # The next levels and the write read a level again: a few rows for each series.
        level = rollup_many(rows, units, timezone, starts).persist()
        fresh |= {unit: level.where(F.col("unit") == unit) for unit in units}
        levels.append(level)
    table.upsert(reduce(DataFrame.unionByName, levels))
    for level in levels:
        level.unpersist()


def rollup_all(table: CandleTable, timezone: str = "UTC") -> None:
    """Derives every unit of the whole 1m table in one shuffle."""
    use_utc(table.spark)
    table.upsert(rollup_nested(table.candles(units=["1m"]), timezone))


def rollup_history(
    table: CandleTable, exchange: str, native_units: frozenset[str], timezone: str = "UTC"
) -> None:
    """Derives what the exchange does not serve itself; days always, 15m from 5m."""
    use_utc(table.spark)
    for base, units in cascade_levels({"15m": "5m"}):
        missing = [unit for unit in units if unit == "1d" or unit not in native_units]
        if missing:
            rows = table.candles(exchange=exchange, units=[base])
            table.upsert(rollup_many(rows, missing, timezone))


def export_history(
    table: CandleTable, export: ExportTable, limit: int = 2000, now: datetime | None = None
) -> None:
    """Exports the newest ``limit`` candles of every series, read newest periods first."""
    use_utc(table.spark)
    export.upsert(to_export(newest_n(table.newest(limit, now), limit)))


def export_latest(table: CandleTable, export: ExportTable, now: datetime) -> None:
    """Exports the previous and current bucket of every series."""
    use_utc(table.spark)
    oldest = min(lookback_start(now, unit) for unit in UNITS)
    export.upsert(to_export(latest_buckets(table.candles(start=oldest), now)))


def apply_retention(export: ExportTable, now: datetime) -> dict[str, int]:
    use_utc(export.spark)
    return export.delete_expired(now)


def refresh_export(table: CandleTable, export: ExportTable, now: datetime) -> dict[str, int]:
    """Exports the newest buckets, then deletes what has expired: one writer for both."""
    export_latest(table, export, now)
    return apply_retention(export, now)


def reconcile(
    table: CandleTable,
    exchange_candles: DataFrame,
    depth: int | dict[str, dict[str, int]],
    report_path: str | None = None,
) -> DataFrame:
    """Compares the newest stored candles with the exchange's own; returns the summary.

    Both sides are written once. Their digests name the blocks that differ, and only pairs of these
    are joined and written, for report and summary.
    """
    use_utc(table.spark)
    served = to_depth(exchange_candles, depth)
    stored = stored_to_depth(table, served, depth)
    kept = [*CANDLE_COLUMNS, "created_at"]
    stored = written(stored.select(*kept), "stored")
    served = written(closed_on_grid(served, ranked=True).select(*CANDLE_COLUMNS), "served")
    blocks = written(compared_blocks(stored, served), "blocks")
    pairs = written(flagged_pairs(stored, served, blocks), "pairs")
    summary = summary_by_digest(pairs, blocks, depth)
    if report_path is not None:
        write_diff_report(diff_rows(pairs), f"{report_path}/diffs")
        write_summary_report(summary, f"{report_path}/summary")
    return summary


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to an intermediate table and read from it."""
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def stored_to_depth(
    table: CandleTable, served: DataFrame, depth: int | dict[str, dict[str, int]]
) -> DataFrame:
    """Newest stored candles, read newest periods first from the newest served candle on."""
    newest = served.agg(F.max("timestamp")).first()[0]
    return to_depth(table.newest(depth, newest), depth)


def reconcile_export(
    export: ExportTable,
    rest: DataFrame,
    market: str = "UPBIT",
    units: tuple[str, ...] = ("Min", "Min15", "Day"),
    check_count: int = 1000,
    report_path: str | None = None,
) -> DataFrame:
    """Compares the newest closed rows of the export store with REST candles.

    The store is read newest periods first, from the newest REST candle on.
    """
    use_utc(export.spark)
    newest = rest.agg(F.max("tms")).first()[0]
    now = None if newest is None else from_epoch(newest)
    summary = export_summary(export.newest_closed(market, units, check_count, now), rest, check_count)
    if report_path is not None:
        write_csv_summary(summary, report_path)
    return summary


def find_gaps(table: CandleTable, units: list[str] | None = None) -> DataFrame:
    use_utc(table.spark)
    return gaps(table.candles(units=units))
