"""Raw trade messages and files to normalised trades.

Every function maps rows to rows, so the same code serves batch and streaming inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import code_to_symbol, from_epoch_ms, quote_of
from candlewick.schemas import BATCHED_MESSAGE, SINGLE_MESSAGE, TRADE, TRADE_FILE


def trades_from_singles(messages: DataFrame, exchange: str = "upbit") -> DataFrame:
    """One trade per JSON message in column ``value``."""
    # Generated columns keep the filter from being pushed below, into a second parse.
    parsed = messages.select(F.inline(F.array(F.from_json("value", SINGLE_MESSAGE))))
    price, amount = F.col("trade_price"), F.col("trade_volume")
    return parsed.where(F.col("code").isNotNull()).select(
        F.lit(exchange).alias("exchange"),
        code_to_symbol("upbit", F.col("code")).alias("symbol"),
        from_epoch_ms("trade_timestamp").alias("timestamp"),
        F.when(F.col("ask_bid") == "ASK", "sell").when(F.col("ask_bid") == "BID", "buy").alias("side"),
        price.alias("price"), amount.alias("amount"), (price * amount).alias("cost"),
        F.col("sequential_id").alias("id"),
        F.lit(None).cast("long").alias("arrival_seq"), F.lit(None).cast("int").alias("arrival_pos"),
    )


def local_trade_time(text: str, utc_offset_hours: int = 9) -> Column:
    """'YYYY-MM-DD HH:MM:SS[.ffffff]' in exchange-local time to UTC, whole milliseconds.

    The hour may be one digit. Unreadable text gives null. A cast reads such texts much faster
    than a pattern with optional parts; the guard keeps out what a cast would also read.
    """
    shape = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$'"
    at = f"CASE WHEN {text} RLIKE {shape} THEN try_cast({text} AS TIMESTAMP_NTZ) END"
    local = f"unix_millis(CAST({at} AS TIMESTAMP))"
    return from_epoch_ms(f"{local} - {utc_offset_hours * 3_600_000}")


def number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def trades_from_batches(
    messages: DataFrame,
    exchange: str = "bithumb",
    buy_flag: str = "1",
    seq: str = "seq",
) -> DataFrame:
    """All trades of the 'transaction' messages in column ``value``.

    ``seq`` names the column that orders messages (an offset); with the position in the list it
    gives the arrival order.
    """
    order = F.col(seq).cast("long")
    # A filter on the type would be pushed below and parse each message again, and so would
    # the non-empty filter that a plain explode implies; an outer explode parses once.
    parsed = messages.select(order.alias("seq"), F.from_json("value", BATCHED_MESSAGE).alias("m"))
    lists = parsed.select(
        "seq", F.when(F.col("m.type") == "transaction", F.col("m.content.list")).alias("list")
    )
    records = lists.select("seq", F.posexplode_outer("list").alias("pos", "r")).where(
        F.col("r").isNotNull()
    ).withColumn("at", local_trade_time("r.contDtm"))
    return records.select(
        F.lit(exchange).alias("exchange"),
        code_to_symbol("bithumb", F.col("r.symbol")).alias("symbol"),
        F.col("at").alias("timestamp"),
        F.when(F.col("r.buySellGb") == buy_flag, "buy").otherwise("sell").alias("side"),
        number(F.col("r.contPrice")).alias("price"),
        number(F.coalesce("r.contQty", "r.units")).alias("amount"),
        number(F.col("r.contAmt")).alias("cost"),
        F.unix_millis(F.col("at").cast("timestamp")).alias("id"),
        F.col("seq").alias("arrival_seq"), F.col("pos").alias("arrival_pos"),
    )


def read_trade_files(spark: SparkSession, path: str, exchange: str = "upbit") -> DataFrame:
    """Landed JSON arrays of trades with zone-less UTC times, cut to milliseconds."""
    rows = spark.read.schema(TRADE_FILE).option("multiLine", True).json(path)
    at = local_trade_time("timestamp", utc_offset_hours=0)
    return rows.select(
        F.lit(exchange).alias("exchange"), "symbol",
        at.alias("timestamp"), "side", "price", "amount",
        (F.col("price") * F.col("amount")).alias("cost"),
        F.col("sequential_id").cast("long").alias("id"),
        F.lit(None).cast("long").alias("arrival_seq"), F.lit(None).cast("int").alias("arrival_pos"),
    )


def trades_from_events(events: DataFrame, exchange: str = "upbit") -> DataFrame:
    """Trades from an event log: type as market, value as price, ``props.k`` as amount.

    Times pass through untouched, so bounds on them still reach the scan.
    """
    amount = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.lit(exchange).alias("exchange"),
        F.concat(F.upper("event_type"), F.lit("/KRW")).alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.col("value").alias("price"), amount.alias("amount"),
        (F.col("value") * amount).alias("cost"),
        F.col("event_id").alias("id"),
        F.col("event_id").alias("arrival_seq"), F.lit(0).alias("arrival_pos"),
    )


def trades_from_lineitem(lineitem: DataFrame, symbol: Column, exchange: str = "upbit") -> DataFrame:
    """A day-grain tape: unit price and quantity per order line, ids that repeat."""
    line_id = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return lineitem.select(
        F.lit(exchange).alias("exchange"), symbol.alias("symbol"),
        F.col("l_shipdate").alias("timestamp"), F.lit("buy").alias("side"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("amount"), F.col("l_extendedprice").alias("cost"),
        line_id.alias("id"), line_id.alias("arrival_seq"), F.lit(0).alias("arrival_pos"),
    )


def quoted_in(trades: DataFrame, quote: str = "KRW") -> DataFrame:
    return trades.where(quote_of(F.col("symbol")) == quote)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed message files, one JSON message per line, as a stream with column ``value``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_ordered_messages(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Landed broker records, one JSON object with ``seq`` and ``value`` per line, as a stream.

    ``seq`` is the record's offset, which orders messages that share a millisecond.
    """
    reader = spark.readStream.schema("seq long, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_trades(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Normalised trades landed as Parquet."""
    reader = spark.readStream.schema(TRADE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
