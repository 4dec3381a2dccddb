"""Row layouts. Timestamps are zone-less UTC throughout."""

from __future__ import annotations

from pyspark.sql import types as T

TRADE = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("side", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("id", T.LongType()),
    # The order of arrival: that of the message, and the place in its list.
    T.StructField("arrival_seq", T.LongType()),
    T.StructField("arrival_pos", T.IntegerType()),
])

CANDLE = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

EXPORT = T.StructType([
    T.StructField("unit", T.StringType()),
    T.StructField("market", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("tms", T.LongType()),
    T.StructField("op", T.DoubleType()),
    T.StructField("hp", T.DoubleType()),
    T.StructField("lp", T.DoubleType()),
    T.StructField("cp", T.DoubleType()),
    T.StructField("tv", T.DoubleType()),
])

SERIES = ["exchange", "unit", "symbol"]
CANDLE_KEYS = ["exchange", "unit", "timestamp", "symbol"]
OHLCV = ["open", "high", "low", "close", "volume"]
CANDLE_COLUMNS = [*CANDLE_KEYS, *OHLCV]

# Batched transaction message: an object holding an array of all-string records.
BATCHED_MESSAGE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("content", T.StructType([
        T.StructField("list", T.ArrayType(T.StructType([
            T.StructField("symbol", T.StringType()),
            T.StructField("buySellGb", T.StringType()),
            T.StructField("contPrice", T.StringType()),
            T.StructField("contQty", T.StringType()),
            T.StructField("units", T.StringType()),
            T.StructField("contAmt", T.StringType()),
            T.StructField("contDtm", T.StringType()),
            T.StructField("updn", T.StringType()),
        ]))),
    ])),
])

# Single-trade message.
SINGLE_MESSAGE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("trade_timestamp", T.LongType()),
    T.StructField("trade_price", T.DoubleType()),
    T.StructField("trade_volume", T.DoubleType()),
    T.StructField("ask_bid", T.StringType()),
    T.StructField("sequential_id", T.LongType()),
])

# Landed trade file rows.
TRADE_FILE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("sequential_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Landed REST candle rows; ``page`` numbers the landed page, later pages win.
REST_CANDLE = T.StructType([
    T.StructField("market", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("candle_date_time_utc", T.StringType()),
    T.StructField("opening_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("trade_price", T.DoubleType()),
    T.StructField("candle_acc_trade_volume", T.DoubleType()),
])

# Landed positional candle rows: [tms, open, high, low, close, volume].
ARRAY_CANDLE = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("ohlcv", T.ArrayType(T.DoubleType())),
])
