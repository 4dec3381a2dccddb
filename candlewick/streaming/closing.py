"""Candles that close by their own symbol's newest bucket.

The default stream closes candles by the global watermark, so a busy symbol closes a quiet one.
Here a symbol's candle closes only when a later bucket of that symbol arrives, however far other
symbols are ahead. What is kept between batches are the trades of each symbol's open bucket, in a
folder per batch: a batch joins them with its own trades, drops repeats, and folds both in the
JVM. A hot symbol's trades are spread by id and combined before the shuffle. A repeated batch
reads the same state and writes the same folders again.

A trade of a bucket that its symbol has closed before is late: it moves no candle and is kept in a
table of its own, from which ``jobs.repair`` takes it. So every trade with usable numbers is in a
candle, is a repeat of one there, or is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.functions import bucket_start
from candlewick.operators.fold import SEQUENCE, Profile, fold_trades, priced
from candlewick.schemas import CANDLE_KEYS, OHLCV, TRADE
from candlewick.session import use_utc

SERIES = ["exchange", "symbol"]
OPEN = "open_bucket"


def close_batch(
    batch: DataFrame, held: DataFrame | None, unit: str, profile: Profile
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The candles that a batch touches, with ``closed``, the trades that stay open, and the late ones.

    ``held`` has the open trades of the batch before.
    """
    trades = priced(batch).select(*TRADE.names)
    late = trades.limit(0)
    if held is not None:
        before = held.groupBy(*SERIES).agg(F.max(bucket_start("timestamp", unit)).alias(OPEN))
        placed = trades.withColumn("bucket", bucket_start("timestamp", unit)).join(before, SERIES, "left")
        is_late = F.coalesce(F.col("bucket") < F.col(OPEN), F.lit(False))
        late = placed.where(is_late).select(*TRADE.names)
        trades = placed.where(~is_late).select(*TRADE.names).unionByName(held.select(*TRADE.names))
    candles = fold_trades(trades, unit, profile, spread_ids=True)
    newest = candles.groupBy(*SERIES).agg(F.max("timestamp").alias("newest"))
    flagged = candles.join(newest, SERIES).withColumn("closed", F.col("timestamp") < F.col("newest"))
    still_open = (
        trades.withColumn("bucket", bucket_start("timestamp", unit)).join(newest, SERIES)
        .where(F.col("bucket") == F.col("newest")).select(*TRADE.names)
    )
    return flagged.drop("newest"), still_open, late


def closing_stream(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    unit: str = "1m",
    profile: Profile = SEQUENCE,
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Writes candle revisions to ``path/revisions``; ``current_candles`` reads them.

    A revision is the number of its batch: each writes its open candles and those it closes. Late
    trades go to ``path/late``; ``late_trades`` reads them.
    """
    spark = use_utc(trades.sparkSession)

    def fold(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        held = None
        if number > 0:
            held = spark.read.schema(TRADE).parquet(f"{path}/open/batch={number - 1}")
        candles, still_open, late = close_batch(batch, held, unit, profile)
        candles.withColumn("revision", F.lit(number).cast("long")).write.mode("overwrite").parquet(
            f"{path}/revisions/batch={number}"
        )
        still_open.write.mode("overwrite").parquet(f"{path}/open/batch={number}")
        late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        batch.unpersist()
        # A batch that is repeated needs the state before it, an older one is of no use.
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/open/batch={number - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        trades.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def late_trades(spark: SparkSession, path: str) -> DataFrame:
    """The trades that came after their symbol had closed their bucket, with ``batch``."""
    schema = StructType([*TRADE.fields, StructField("batch", LongType())])
    return spark.read.schema(schema).parquet(f"{path}/late")


def current_candles(revisions: DataFrame) -> DataFrame:
    """The latest revision of each candle, with ``closed``."""
    return revisions.groupBy(*CANDLE_KEYS).agg(
        *[F.max_by(c, "revision").alias(c) for c in (*OHLCV, "closed")]
    )
