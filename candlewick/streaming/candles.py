"""Live candles with Structured Streaming.

Watermarks need a zoned timestamp, so streams run on one (session zone UTC) and hand back
zone-less candles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from candlewick.functions.times import tumbling
from candlewick.operators.fold import (
    SEQUENCE,
    Profile,
    as_states,
    merged_ohlcv,
    priced,
    repeats_dropped,
    seed_states,
)
from candlewick.operators.rollup import rolled_ohlcv
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.sources.tables import CandleTable, stamped_trades

# How long a candle stays open for late trades by default. Later ones are dropped and counted
# (``LateTrades``); they would otherwise overwrite the finished candle.
LATENESS = "1 minute"


def watermarked(rows: DataFrame, lateness: str = LATENESS) -> DataFrame:
    at = F.col("timestamp").cast("timestamp")
    return rows.withColumn("timestamp", at).withWatermark("timestamp", lateness)


def distinct_trades(trades: DataFrame) -> DataFrame:
    """Drops re-sent trades; ids leave the state once the watermark passes them."""
    keys = ["exchange", "symbol", "id"]
    return repeats_dropped(trades, lambda known: known.dropDuplicatesWithinWatermark(keys))


def finished_columns(unit: str) -> list:
    start = F.col("window.start").cast("timestamp_ntz")
    return [
        F.lit(unit).alias(c) if c == "unit" else
        start.alias(c) if c == "timestamp" else F.col(c)
        for c in CANDLE_COLUMNS
    ]


def trade_stream_states(
    trades: DataFrame, profile: Profile = SEQUENCE, lateness: str = LATENESS
) -> DataFrame:
    rows = watermarked(priced(trades), lateness)
    if profile.repeats:
        rows = distinct_trades(rows)
    return as_states(rows, profile)


def candle_stream(
    trades: DataFrame,
    unit: str = "1m",
    profile: Profile = SEQUENCE,
    timezone: str = "UTC",
    lateness: str = LATENESS,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Streaming candles. Update mode emits open candles too, append mode closed ones only.

    ``seeds`` is a stream of stored candles that a cold start continues (``seed_stream``). A
    restart must name the same sources, so it passes the same unchanged stream again.
    """
    states = trade_stream_states(trades, profile, lateness)
    if seeds is not None:
        states = states.unionByName(seed_states(watermarked(seeds, lateness)))
    window = tumbling("timestamp", unit, timezone).alias("window")
    candles = states.groupBy(window, "symbol", "exchange").agg(*merged_ohlcv())
    return candles.select(*finished_columns(unit))


def chained_candle_stream(
    trades: DataFrame,
    units: list[str],
    profile: Profile = SEQUENCE,
    lateness: str = LATENESS,
) -> DataFrame:
    """Closed candles of the last unit, each unit folded from the one before in one query.

    Append mode only: a level may start once the level below is final.
    """
    states = trade_stream_states(trades, profile, lateness)
    window = tumbling("timestamp", units[0]).alias("window")
    candles = states.groupBy(window, "symbol", "exchange").agg(*merged_ohlcv())
    for unit in units[1:]:
        base = candles.withColumn("timestamp", F.col("window.start"))
        grid = tumbling(F.window_time("window"), unit).alias("window")
        candles = base.groupBy(grid, "symbol", "exchange").agg(*rolled_ohlcv())
    return candles.select(*finished_columns(units[-1]))


def write_seeds(table: CandleTable, exchange: str, path: str, unit: str = "1m") -> None:
    """Lands the latest stored candle per symbol where a cold start can stream it from."""
    table.latest(exchange, unit).select(*CANDLE_COLUMNS).write.mode("overwrite").parquet(path)


def seed_stream(table: CandleTable, exchange: str, path: str, checkpoint: str) -> DataFrame:
    """Stored candles for ``candle_stream``, landed once and before the stream's first start.

    New files in ``path`` would count as new input, so a stream that has a checkpoint reads
    what it was given at first.
    """
    spark = table.spark
    started = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    if not started.getFileSystem(spark._jsc.hadoopConfiguration()).exists(started):
        write_seeds(table, exchange, path)
    schema = StructType([f for f in table.schema.fields if f.name in CANDLE_COLUMNS])
    return spark.readStream.schema(schema).parquet(path)


def upsert_stream(
    candles: DataFrame,
    table: CandleTable,
    checkpoint: str,
    mode: str = "update",
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Upserts every emitted candle, in the versions of the stream's batches.

    A batch that is repeated after a crash repeats its upserts; one that is older than what this
    stream has written to a candle changes nothing. ``every=None`` drains what is there and stops.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        candles.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, number: table.upsert(batch, version=number, writer=checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = "3 seconds"
) -> StreamingQuery:
    """Exactly-once Parquet sink for append-mode streams."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def trade_sink(trades: DataFrame, path: str, checkpoint: str, every: str | None = "3 seconds") -> StreamingQuery:
    """Appends trades with their ingest time, partitioned by exchange and day."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stamped_trades(trades).writeStream.outputMode("append").format("parquet")
        .partitionBy("exchange", "day")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


class LateTrades(StreamingQueryListener):
    """Counts the rows that watermarks drop, per query, from every progress event.

    Add it with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        rows = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[key] = self.dropped.get(key, 0) + rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
