"""Late trades kept apart (T5).

Stateful operators drop a trade that is not newer than their watermark, without a trace. Here the
same bound is applied before them: a first query lands each batch of trades, the late ones in
``late=true`` and the others in ``late=false``, and candles are folded from the latter. So every trade
is either in a candle or in the table of late ones, from which ``jobs.repair`` takes it.

The bound of a batch is the newest timestamp of all batches before it less ``lateness``. It lies in
``<path>-marks``, one row for each batch. A repeated batch reads the mark before it and overwrites its own
folders, under new file names: a reader that has seen the first ones reads its trades again, which
the repeats of trades with ids drop.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from candlewick.schemas import TRADE
from candlewick.session import use_utc
from candlewick.streaming.candles import LATENESS


def mark_after(spark: SparkSession, path: str, batch: int):
    """The newest timestamp up to and with a batch; null before the first."""
    if batch < 0:
        return None
    return spark.read.parquet(f"{path}-marks/batch={batch}").first()["newest"]


def land_batch(batch: DataFrame, number: int, path: str, lateness: str) -> None:
    spark = batch.sparkSession
    trades = batch.select(*TRADE.names).persist()
    mark = mark_after(spark, path, number - 1)
    bound = F.lit(mark).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
    late = F.coalesce(F.col("timestamp") <= bound, F.lit(False))
    (
        trades.withColumns({"late": late, "batch": F.lit(number).cast("long")})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("late", "batch").parquet(path)
    )
    newest = trades.agg(F.max("timestamp")).first()[0]
    newest = max((t for t in (mark, newest) if t is not None), default=None)
    spark.createDataFrame([(newest,)], "newest timestamp_ntz").write.mode("overwrite").parquet(
        f"{path}-marks/batch={number}"
    )
    trades.unpersist()


def landing_stream(
    trades: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS, every: str | None = "3 seconds",
) -> StreamingQuery:
    """Lands all trades in ``path``, by whether they are late. ``every=None`` drains and stops."""
    use_utc(trades.sparkSession)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        trades.writeStream
        .foreachBatch(lambda batch, number: land_batch(batch, number, path, lateness))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def create_landing(spark: SparkSession, path: str) -> None:
    """Makes the folder of trades in time, which a stream must find."""
    spark.createDataFrame([], TRADE).write.mode("ignore").parquet(f"{path}/late=false/batch=-1")


def in_time(spark: SparkSession, path: str) -> DataFrame:
    """The landed trades that are not late, as a stream. It takes all files that are there at a time,
    so that it never sees a part of a landed batch and its watermark stays behind the marks."""
    return spark.readStream.schema(TRADE).parquet(f"{path}/late=false")


def landed_trades(spark: SparkSession, path: str, folders: str = "") -> DataFrame:
    """All landed trades, with ``late`` and ``batch``."""
    schema = StructType([*TRADE.fields, StructField("late", BooleanType()), StructField("batch", LongType())])
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}{folders}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def late_trades(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """The late trades of the batches after ``after``, with ``batch``."""
    return landed_trades(spark, path, "/late=true").where(F.col("batch") > after).drop("late")
