"""Every operator as a query over the given tables, next to SQL with the same result.

Each query reads its tables whole. Trades come from ``events`` (a market per event type) or
from ``lineitem`` (a day-grain tape whose trade ids repeat). Where two sources of candles are
compared, the stored side has lost every trade of one amount.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import bucket_ms, bucket_start, epoch_ms, from_epoch_ms, is_aligned, ts_literal
from candlewick.functions.symbols import join_ids
from candlewick.operators import compare, digest, export, series
from candlewick.operators.fold import ARRIVAL, SEQUENCE, first_of_each, fold_trades
from candlewick.operators.fold import as_states, merge_states, seed_states
from candlewick.operators.rollup import (
    rollup, rollup_all, rollup_cascade, rollup_latest, rollup_many, rollup_nested, rollup_range,
)
from candlewick.plans.jobs import load_history, reconcile, reconcile_export, repair, written
from candlewick.plans.jobs import stream_candles, stream_candles_and_late
from candlewick.plans.jobs import rollup_all as fill_table
from candlewick.plans.jobs import rollup_latest as refresh_table
from candlewick.session import shared_folder, use_utc
from candlewick.sources import history, trades as trade_source
from candlewick.sources.reports import write_csv_summary
from candlewick.sources.tables import CandleTable, ExportTable, append_trades
from candlewick.streaming import candles as live
from candlewick.streaming.closing import closing_stream, current_candles, late_trades
from candlewick.streaming.late import landed_trades
from candlewick.units import CHECK_DEPTHS, DERIVED_UNITS, UNITS, lookback_start

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

NOW = datetime(2024, 1, 29, 13, 37, 21)
LOST_AMOUNT = 50.0
CREATED_DELAY_S = 30


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = lambda spark, sf_dir: run(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return register


# ---- inputs ---------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def trades(spark: SparkSession, sf_dir: str, exchange: str = "upbit") -> DataFrame:
    return trade_source.trades_from_events(events(spark, sf_dir), exchange)


def kept_trades(spark: SparkSession, sf_dir: str, exchange: str = "upbit") -> DataFrame:
    return trades(spark, sf_dir, exchange).where(F.col("amount") != LOST_AMOUNT)


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_trades(trades(spark, sf_dir))


def several_units(one_minute: DataFrame, units: list[str]) -> DataFrame:
    """One pass for all units: rolling 1m up to 1m changes nothing."""
    return rollup_many(one_minute, units)


def tape(spark: SparkSession, sf_dir: str, symbol: Column) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return trade_source.trades_from_lineitem(lineitem, symbol)


BATCHES = 4
# Each batch is written and read by as many tasks.
FILES = 8


def landed(spark: SparkSession, rows: DataFrame, order: str, batches: int = BATCHES) -> str:
    """A folder with the rows by ranges of ``order``, FILES files each, that stream one range after the other."""
    path = shared_folder(spark, "landed")
    cuts = rows.select(F.percentile_approx(order, [k / batches for k in range(1, batches)], 10_000)).first()[0]
    edges = [None, *(cuts or []), None]
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.where(F.col(order) > low)
        if high is not None:
            part = part.where(F.col(order) <= high)
        part.drop(order).repartition(FILES).write.mode("append").parquet(path)
    return path


def trade_stream(spark: SparkSession, rows: DataFrame, order: Column | None = None) -> DataFrame:
    """Trades as a stream of several micro-batches, by time unless ``order`` says otherwise."""
    at = F.unix_micros(F.col("timestamp").cast("timestamp")) if order is None else order
    path = landed(spark, rows.withColumn("landed_at", at), "landed_at")
    return trade_source.stream_trades(spark, path, max_files=FILES)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_stream(spark, trades(spark, sf_dir))


# ---- SQL building blocks --------------------------------------------------------------

SQL_INTERVALS = {
    "1m": "1 minute", "3m": "3 minutes", "5m": "5 minutes", "10m": "10 minutes",
    "15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour", "4h": "4 hours",
    "1d": "1 day", "1w": "7 days",
}
UTC_ORIGIN, KST_ORIGIN = "1970-01-05 00:00:00", "1970-01-04 15:00:00"
SQL_TRADES = """trades AS (
  SELECT 'upbit' AS exchange, upper(event_type) || '/KRW' AS symbol, ts AS timestamp,
         value AS price, json_extract_string(props, '$.k')::DOUBLE AS amount, event_id AS id
  FROM events)"""


def sql_bucket(unit: str, column: str = "timestamp", origin: str = UTC_ORIGIN) -> str:
    return f"time_bucket(INTERVAL '{SQL_INTERVALS[unit]}', {column}, TIMESTAMP '{origin}')"


def sql_candles(
    unit: str, where: str = "true", origin: str = UTC_ORIGIN, source: str = "trades",
    exchange: str = "upbit",
) -> str:
    return f"""SELECT '{exchange}' AS exchange, '{unit}' AS unit,
      {sql_bucket(unit, origin=origin)} AS timestamp, symbol,
      first(price ORDER BY timestamp, id) AS open, max(price) AS high, min(price) AS low,
      last(price ORDER BY timestamp, id) AS close,
      sum(amount::DECIMAL(28, 8))::DOUBLE AS volume
    FROM {source} WHERE {where} GROUP BY ALL"""


def sql_units(units: list[str], where: str = "true", exchange: str = "upbit") -> str:
    return " UNION ALL ".join(sql_candles(u, where, exchange=exchange) for u in units)


def with_trades(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([SQL_TRADES, *ctes]) + " " + body


def sql_ms(column: str) -> str:
    return f"epoch_ms({column})"


# ---- A1-A6, A12, A13: folds and rollups -----------------------------------------------

for _unit in ("1m", "1h", "1d", "1w"):
    query(f"candles_{_unit}", with_trades(sql_candles(_unit)))(
        lambda spark, sf_dir, unit=_unit: fold_trades(trades(spark, sf_dir), unit)
    )

query("candles_arrival_1m", with_trades(sql_candles("1m", exchange="bithumb")))(
    lambda spark, sf_dir: fold_trades(trades(spark, sf_dir, "bithumb"), profile=ARRIVAL)
)

for _unit in DERIVED_UNITS:
    query(f"rollup_{_unit}", with_trades(sql_candles(_unit)))(
        lambda spark, sf_dir, unit=_unit: rollup(minutes(spark, sf_dir), unit)
    )

for _unit in ("1d", "1w"):
    query(f"rollup_{_unit}_kst", with_trades(sql_candles(_unit, origin=KST_ORIGIN)))(
        lambda spark, sf_dir, unit=_unit: rollup(minutes(spark, sf_dir), unit, "KST")
    )

query("rollup_all_units", with_trades(sql_units(DERIVED_UNITS)))(
    lambda spark, sf_dir: rollup_all(minutes(spark, sf_dir))
)
query("rollup_cascade", with_trades(sql_units(DERIVED_UNITS)))(
    lambda spark, sf_dir: rollup_cascade(minutes(spark, sf_dir))
)
query("rollup_nested", with_trades(sql_units(DERIVED_UNITS)))(
    lambda spark, sf_dir: rollup_nested(minutes(spark, sf_dir))
)
# Units the source serves itself stay out, days are derived all the same, 15m builds on 5m.
query("rollup_history", with_trades(sql_units(["15m", "4h", "1d", "1w"])))(
    lambda spark, sf_dir: rollup_cascade(
        several_units(minutes(spark, sf_dir), ["1m", "3m", "5m", "10m", "30m", "1h"]),
        bases={"15m": "5m"}, native=frozenset({"3m", "5m", "10m", "30m", "1h"}),
    )
)


@query("rollup_latest_1h", with_trades(
    sql_candles("1h", f"timestamp >= TIMESTAMP '{lookback_start(NOW, '1h')}'")))
def rollup_latest_1h(spark, sf_dir):
    return rollup_latest(minutes(spark, sf_dir), "1h", NOW)


@query("rollup_range_week", with_trades(f"""
    SELECT exchange, '1w' AS unit, TIMESTAMP '2024-01-15' AS timestamp, symbol,
           first(open ORDER BY timestamp) AS open, max(high) AS high, min(low) AS low,
           last(close ORDER BY timestamp) AS close,
           sum(volume::DECIMAL(28, 8))::DOUBLE AS volume
    FROM days WHERE timestamp >= TIMESTAMP '2024-01-15' AND timestamp < TIMESTAMP '2024-01-22'
    GROUP BY exchange, symbol""", f"days AS ({sql_candles('1d')})"))
def rollup_range_week(spark, sf_dir):
    days = fold_trades(trades(spark, sf_dir), "1d")
    return rollup_range(days, "1w", datetime(2024, 1, 15), datetime(2024, 1, 22))


@query("stored_cascade_latest", with_trades(" UNION ALL ".join(
    sql_candles(u, f"timestamp >= TIMESTAMP '{lookback_start(NOW, u)}'") for u in DERIVED_UNITS)))
def stored_cascade_latest(spark, sf_dir):
    """The incremental job on a stored table whose newest trades arrive after it was filled."""
    table = CandleTable(spark, shared_folder(spark, "cascade"))
    table.create()
    cut = ts_literal(lookback_start(NOW, "3m"))
    whole = trades(spark, sf_dir)
    table.upsert(fold_trades(whole.where(F.col("timestamp") < cut)))
    fill_table(table)
    table.upsert(fold_trades(whole.where(F.col("timestamp") >= cut)))
    refresh_table(table, NOW)
    oldest = min(lookback_start(NOW, u) for u in DERIVED_UNITS)
    stored = table.candles(units=DERIVED_UNITS, start=oldest)
    return export.latest_buckets(stored, NOW).drop("created_at")


SQL_TAPE = """tape AS (
  SELECT 'upbit' AS exchange, 'P' || l_partkey AS symbol, l_returnflag AS flag,
         l_shipdate AS timestamp, l_extendedprice / l_quantity AS price, l_quantity AS amount,
         l_orderkey * 8 + l_linenumber AS id
  FROM lineitem)"""


def sql_first(keys: str) -> str:
    return f"""SELECT * FROM tape QUALIFY row_number() OVER (
      PARTITION BY {keys} ORDER BY timestamp, price, amount, symbol) = 1"""


# The tape repeats ids across parts, so the first trade of an id wins over the whole tape.
@query("tape_candles_dedup",
       f"WITH {SQL_TAPE}, first_rows AS ({sql_first('id')}) "
       + sql_candles("1d", source="first_rows"))
def tape_candles_dedup(spark, sf_dir):
    part = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    rows = tape(spark, sf_dir, part).select("id", "timestamp", "price", "amount", "symbol", "exchange")
    return fold_trades(first_of_each(rows, ["id"]), "1d")


# Three markets hold the whole tape; ids repeat inside a week of one market.
@query("tape_weeks_hot", f"""WITH {SQL_TAPE}, hot AS (
      SELECT exchange, flag AS symbol, timestamp, price, amount, id FROM tape
      QUALIFY row_number() OVER (PARTITION BY flag, {sql_bucket('1w')}, id
                                 ORDER BY timestamp, price, amount) = 1)
    """ + sql_candles("1w", source="hot"))
def tape_weeks_hot(spark, sf_dir):
    return fold_trades(tape(spark, sf_dir, F.col("l_returnflag")), "1w")


# Amounts of 1e-9 and of 1e13 keep their sums.
@query("candles_extreme_volumes", with_trades(
    sql_candles("1h", source="extreme").replace(
        "sum(amount::DECIMAL(28, 8))::DOUBLE",
        "sum(if(amount >= 1, amount, 0)::DECIMAL(38, 0))::DOUBLE"
        " + sum(if(amount < 1, amount, 0)::DECIMAL(38, 16))::DOUBLE"), """extreme AS (
      SELECT * REPLACE (symbol || if(id % 2 = 0, '/TINY', '/HUGE') AS symbol,
                        amount * if(id % 2 = 0, 1e-9, 1e13) AS amount) FROM trades)"""))
def candles_extreme_volumes(spark, sf_dir):
    even = F.col("id") % 2 == 0
    rows = trades(spark, sf_dir).withColumns({
        "symbol": F.concat("symbol", F.when(even, "/TINY").otherwise("/HUGE")),
        "amount": F.col("amount") * F.when(even, F.lit(1e-9)).otherwise(F.lit(1e13)),
    })
    return fold_trades(rows, "1h")


# Trades of no number, of infinitely much and of more than any market has move no candle; the largest
# amounts that count (all whole here) are summed without overflow.
@query("candles_absurd_numbers", with_trades(
    sql_candles("1d", "id % 9 NOT IN (1, 2, 3, 4)", source="odd").replace(
        "sum(amount::DECIMAL(28, 8))::DOUBLE", "sum(amount::HUGEINT)::DOUBLE"),
    "odd AS (SELECT * REPLACE (if(id % 9 = 5, 8e18, amount) AS amount) FROM trades)"))
def candles_absurd_numbers(spark, sf_dir):
    def odd(column: str, values: dict[int, str]) -> Column:
        cases = " ".join(f"WHEN {rest} THEN {value}" for rest, value in values.items())
        return F.expr(f"CASE id % 9 {cases} ELSE {column} END")

    rows = trades(spark, sf_dir).withColumns({
        "price": odd("price", {1: "double('Infinity')", 2: "double('NaN')"}),
        "amount": odd("amount", {3: "double('Infinity')", 4: "1e19D", 5: "8e18D"}),
    })
    return fold_trades(rows, "1d")


# A third of the trades have no id and count one by one; the others are all sent twice.
@query("candles_null_ids", with_trades(sql_candles("15m")))
def candles_null_ids(spark, sf_dir):
    rows = trades(spark, sf_dir)
    marked = rows.withColumn("id", F.when(F.col("id") % 3 != 0, F.col("id")))
    return fold_trades(marked.unionByName(marked.where("id IS NOT NULL")), "15m")


# Half of a minute is stored, the rest arrives later: merging equals folding everything.
@query("seeded_merge", with_trades(sql_candles("1m")))
def seeded_merge(spark, sf_dir):
    both = trades(spark, sf_dir)
    in_first_half = F.pmod(epoch_ms("timestamp"), F.lit(60_000)) < 30_000
    seeds = seed_states(fold_trades(both.where(in_first_half)))
    return merge_states(seeds.unionByName(as_states(both.where(~in_first_half), SEQUENCE)))


# ---- F5-F8: buckets and alignment -----------------------------------------------------


def sql_bucket_columns(origin: str) -> str:
    columns = ", ".join(
        f"{sql_ms(sql_bucket(u, 'ts', origin))} AS start_{u}" for u in UNITS
    )
    return f"SELECT event_id, {columns} FROM events"


for _zone, _origin in (("UTC", UTC_ORIGIN), ("KST", KST_ORIGIN)):
    query(f"buckets_{_zone.lower()}", sql_bucket_columns(_origin))(
        lambda spark, sf_dir, zone=_zone: events(spark, sf_dir).select(
            "event_id",
            *[bucket_ms("ts", u, zone).alias(f"start_{u}") for u in UNITS],
        )
    )

query("align_filter", "SELECT event_id, " + ", ".join(
    f"{sql_bucket(u, 'm')} = m AS on_{u}" for u in UNITS
) + " FROM (SELECT event_id, time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01') AS m"
    " FROM events)")(
    lambda spark, sf_dir: events(spark, sf_dir).select(
        "event_id", *[is_aligned("ts", u).alias(f"on_{u}") for u in UNITS]
    )
)

# ---- S1, S2, F1-F4, K1: trade sources and sink ----------------------------------------


@query("upbit_parse", """
    SELECT 'upbit' AS exchange, upper(event_type) || '/KRW' AS symbol,
           date_trunc('milliseconds', ts) AS timestamp,
           CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, value AS price,
           json_extract_string(props, '$.k')::DOUBLE AS amount,
           value * json_extract_string(props, '$.k')::DOUBLE AS cost, event_id AS id
    FROM events""")
def upbit_parse(spark, sf_dir):
    message = F.struct(
        F.lit("trade").alias("type"),
        F.concat(F.lit("KRW-"), F.upper("event_type")).alias("code"),
        epoch_ms("ts").alias("trade_timestamp"),
        F.col("value").alias("trade_price"),
        F.get_json_object("props", "$.k").cast("double").alias("trade_volume"),
        F.when(F.col("user_id") % 2 == 0, "BID").otherwise("ASK").alias("ask_bid"),
        F.col("event_id").alias("sequential_id"),
    )
    messages = events(spark, sf_dir).select(F.to_json(message).alias("value"))
    return trade_source.trades_from_singles(messages).drop("arrival_seq", "arrival_pos")


# Two records per message (the second a day on, its quantity with a thousands comma), and a
# message of another type that must not surface.
@query("bithumb_parse", """
    SELECT 'bithumb' AS exchange, upper(event_type) || '/KRW' AS symbol,
           date_trunc('milliseconds', ts) + INTERVAL 1 DAY * pos AS timestamp,
           CASE WHEN (user_id + pos) % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
           value AS price, json_extract_string(props, '$.k')::DOUBLE + 1000 * pos AS amount,
           value * 2 AS cost,
           epoch_ms(date_trunc('milliseconds', ts)) + 86400000 * pos AS id,
           event_id AS arrival_seq, pos AS arrival_pos
    FROM events, (VALUES (0), (1)) AS positions(pos) WHERE event_type <> 'error'""")
def bithumb_parse(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    local = F.col("ts") + F.expr("INTERVAL 9 HOURS")
    hour = F.date_format(local, "H:mm:ss.SSSSSS")

    def record(pos: int) -> Column:
        day = F.date_format(local + F.expr(f"INTERVAL {pos} DAYS"), "yyyy-MM-dd")
        quantity = k if pos == 0 else F.concat(F.lit("1,"), F.lpad(k, 3, "0"))
        return F.struct(
            F.concat(F.upper("event_type"), F.lit("_KRW")).alias("symbol"),
            ((F.col("user_id") + pos) % 2 + 1).cast("string").alias("buySellGb"),
            F.col("value").cast("string").alias("contPrice"),
            quantity.alias("contQty"),
            (F.col("value") * 2).cast("string").alias("contAmt"),
            F.concat_ws(" ", day, hour).alias("contDtm"),
            F.lit("up").alias("updn"),
        )

    kind = F.when(F.col("event_type") == "error", "status").otherwise("transaction")
    content = F.struct(F.array(record(0), record(1)).alias("list"))
    message = F.struct(kind.alias("type"), content.alias("content"))
    messages = events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.to_json(message).alias("value")
    )
    return trade_source.trades_from_batches(messages)


# Landed files of JSON arrays, a thousand trades each.
@query("trade_files", """
    SELECT 'upbit' AS exchange, upper(event_type) || '/KRW' AS symbol,
           date_trunc('milliseconds', ts) AS timestamp, value AS price,
           json_extract_string(props, '$.k')::DOUBLE AS amount, event_id AS id FROM events""")
def trade_files(spark, sf_dir):
    row = F.struct(
        "symbol", "side", "price", "amount", F.col("id").cast("string").alias("sequential_id"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    arrays = trades(spark, sf_dir).groupBy(F.floor(F.col("id") / 1000).alias("file")).agg(
        F.to_json(F.collect_list(row)).alias("value")
    )
    path = shared_folder(spark, "files")
    arrays.repartition("file").write.partitionBy("file").text(path)
    found = trade_source.read_trade_files(spark, f"{path}/*/*")
    return found.select("exchange", "symbol", "timestamp", "price", "amount", "id")


# Names and codes of a market from its two parts, for both exchanges.
@query("market_ids", """
    SELECT DISTINCT b || '/' || q AS upbit_symbol, q || '-' || b AS upbit_code,
           b || '/' || q AS bithumb_symbol, b || '_' || q AS bithumb_code
    FROM (SELECT upper(event_type) AS b, if(event_type = 'signup', 'BTC', 'KRW') AS q FROM events)""")
def market_ids(spark, sf_dir):
    base = F.upper("event_type")
    quote = F.when(F.col("event_type") == "signup", "BTC").otherwise("KRW")
    named = [
        column.alias(f"{exchange}_{kind}") for exchange in ("upbit", "bithumb")
        for kind, column in zip(("symbol", "code"), join_ids(exchange, base, quote))
    ]
    return events(spark, sf_dir).select(*named).distinct()


@query("krw_filter", """
    SELECT event_id AS id, upper(event_type) || '/' ||
           CASE event_type WHEN 'signup' THEN 'BTC' ELSE 'KRW' END AS symbol
    FROM events WHERE event_type <> 'signup'""")
def krw_filter(spark, sf_dir):
    quote = F.when(F.col("event_type") == "signup", "BTC").otherwise("KRW")
    named = events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.concat_ws("/", F.upper("event_type"), quote).alias("symbol")
    )
    return trade_source.quoted_in(named)


@query("trade_sink", with_trades(
    "SELECT exchange, symbol, timestamp, price, amount, id FROM trades"))
def trade_sink(spark, sf_dir):
    path = shared_folder(spark, "trades")
    append_trades(trades(spark, sf_dir), path)
    return spark.read.parquet(path).select("exchange", "symbol", "timestamp", "price", "amount", "id")


# ---- S3-S5, S9: history ---------------------------------------------------------------

HISTORY_UNITS = [*UNITS, "1M"]


def array_rows(spark, sf_dir) -> DataFrame:
    """Every trade as a positional candle row of every served unit, at its own time."""
    price = F.col("price")
    row = F.array(epoch_ms("timestamp").cast("double"), price, price + 2, price - 1,
                  price + 1, F.col("amount"))
    return trades(spark, sf_dir).select(
        "exchange", F.explode(F.array(*map(F.lit, HISTORY_UNITS))).alias("unit"), "symbol",
        row.alias("ohlcv"),
    )


SQL_ARRAY_ROWS = f"""array_rows AS (
  SELECT exchange, unit, date_trunc('milliseconds', timestamp) AS timestamp, symbol,
         price AS open, price + 2 AS high, price - 1 AS low, price + 1 AS close,
         amount AS volume
  FROM trades, (VALUES {", ".join(f"('{unit}')" for unit in HISTORY_UNITS)}) AS served(unit))"""

query("history_arrays", with_trades(
    "SELECT * FROM array_rows WHERE unit <> '1M'", SQL_ARRAY_ROWS))(
    lambda spark, sf_dir: history.candles_from_arrays(array_rows(spark, sf_dir))
)


def sql_snapped(unit: str) -> str:
    return f"""SELECT * REPLACE ({sql_bucket(unit)} AS timestamp) FROM array_rows
      WHERE unit = '{unit}'
        AND date_trunc('minute', timestamp) = {sql_bucket(unit)}
      QUALIFY row_number() OVER (
        PARTITION BY symbol, {sql_bucket(unit)} ORDER BY array_rows.timestamp DESC, open DESC) = 1"""


# Loaded through the store, whose keys must be unique: the last of several twins counts.
@query("history_snap", with_trades(
    " UNION ALL ".join(sql_snapped(unit) for unit in UNITS if unit != "1d"), SQL_ARRAY_ROWS))
def history_snap(spark, sf_dir):
    table = CandleTable(spark, shared_folder(spark, "history"))
    load_history(array_rows(spark, sf_dir), table, native_grid=True)
    return table.candles().drop("created_at")


# Page 1 holds the candles of a lossy store, page 2 the whole ones, in other places.
@query("history_pages", with_trades("""
    SELECT exchange, unit, timestamp, symbol, open, high, low, close, volume FROM (
      SELECT * FROM (
        SELECT * FROM pages2
        QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY page DESC) = 1)
      QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) BETWEEN 11 AND 500)
    """, f"""pages2 AS (SELECT *, 1 AS page FROM ({sql_candles('1m')})
      UNION ALL SELECT *, 2 AS page FROM ({sql_candles('1m', f'amount <> {LOST_AMOUNT}')}))"""))
def history_pages(spark, sf_dir):
    pages = minutes(spark, sf_dir).withColumn("page", F.lit(1)).unionByName(
        fold_trades(kept_trades(spark, sf_dir)).withColumn("page", F.lit(2))
    )
    return history.history_from_pages(pages, since=10, limit=500)


def rest_rows(candles: DataFrame, page: int) -> DataFrame:
    """Candles as REST objects, as their source serves them."""
    exported = export.to_export(candles)
    when = F.date_format(from_epoch_ms("tms"), "yyyy-MM-dd'T'HH:mm:ss")
    return exported.select(
        F.col("code").alias("market"), "unit", F.lit(page).cast("long").alias("page"),
        when.alias("candle_date_time_utc"), F.col("op").alias("opening_price"),
        F.col("hp").alias("high_price"), F.col("lp").alias("low_price"),
        F.col("cp").alias("trade_price"), F.col("tv").alias("candle_acc_trade_volume"),
    )


EXPORT_NAMES = " ".join(f"WHEN '{u.name}' THEN '{u.export_name}'" for u in UNITS.values())
SQL_CODES = {
    "upbit": "'KRW-' || split_part(symbol, '/', 1)",
    "bithumb": "replace(symbol, '/', '_')",
}


def sql_export(source: str, exchange: str = "upbit") -> str:
    return f"""SELECT CASE unit {EXPORT_NAMES} END AS unit, upper(exchange) AS market,
      {SQL_CODES[exchange]} AS code, epoch_ms(timestamp) AS tms, open AS op, high AS hp,
      low AS lp, close AS cp, volume AS tv FROM {source}"""


@query("rest_normalise", with_trades(
    sql_export("hours"), f"hours AS ({sql_candles('1h')})"))
def rest_normalise(spark, sf_dir):
    first = rest_rows(fold_trades(kept_trades(spark, sf_dir), "1h"), page=1)
    second = rest_rows(fold_trades(trades(spark, sf_dir), "1h"), page=2)
    return history.rest_to_export(first.unionByName(second))


# ---- K2, W1-W5, A7, A11, L1: store and serving ----------------------------------------


def sql_upsert(unit: str) -> str:
    sides = {1: f"amount <> {LOST_AMOUNT}", 3: "price < 100", 2: "true"}
    versions = " UNION ALL ".join(
        f"SELECT *, {v} AS v FROM ({sql_candles(unit, where)})" for v, where in sides.items()
    )
    return with_trades(f"""SELECT * EXCLUDE (v) FROM ({versions})
      QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY v DESC) = 1""")


def upserted(spark, sf_dir) -> CandleTable:
    """Three writes of the same keys, not in version order."""
    table = CandleTable(spark, shared_folder(spark, "upsert"))
    whole = trades(spark, sf_dir)
    table.upsert(fold_trades(kept_trades(spark, sf_dir), "15m"), version=1)
    table.upsert(fold_trades(whole.where(F.col("price") < 100), "15m"), version=3)
    table.upsert(fold_trades(whole, "15m"), version=2)
    return table


query("upsert_latest_wins", sql_upsert("15m"))(
    lambda spark, sf_dir: upserted(spark, sf_dir).candles(units=["15m"]).drop("created_at")
)


# What lies in the files: every key once.
@query("upsert_compacted", sql_upsert("15m"))
def upsert_compacted(spark, sf_dir):
    return upserted(spark, sf_dir).raw().drop("_w", "_v", "p", "created_at")


# Four threads write a quarter of the candles each, in two versions, to the same partitions.
@query("upsert_parallel", with_trades(sql_candles("15m")))
def upsert_parallel(spark, sf_dir):
    table = CandleTable(spark, shared_folder(spark, "upsert"))
    table.create()
    whole = fold_trades(trades(spark, sf_dir), "15m")
    lossy = fold_trades(kept_trades(spark, sf_dir), "15m")

    def write(quarter: int) -> None:
        mine = F.pmod(F.hash("symbol", "timestamp"), F.lit(4)) == quarter
        for candles in (lossy, whole):
            table.upsert(candles.where(mine))

    with ThreadPoolExecutor(4) as writers:
        list(writers.map(write, range(4)))
    return table.candles(units=["15m"]).drop("created_at")


# Written whole, then overwritten in part.
@query("upsert_over_base", sql_upsert("15m"))
def upsert_over_base(spark, sf_dir):
    table = CandleTable(spark, shared_folder(spark, "upsert"))
    whole = trades(spark, sf_dir)
    table.upsert(fold_trades(kept_trades(spark, sf_dir), "15m"), version=1)
    table.upsert(fold_trades(whole, "15m"), version=2)
    table.upsert(fold_trades(whole.where(F.col("price") < 100), "15m"), version=3)
    return table.candles(units=["15m"]).drop("created_at")


query("latest_per_symbol", with_trades("""
    SELECT * FROM minutes
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1""",
    f"minutes AS ({sql_candles('1m')})"))(
    lambda spark, sf_dir: series.latest_per_series(minutes(spark, sf_dir))
)
query("newest_n_per_symbol", with_trades("""
    SELECT * FROM units
    QUALIFY row_number() OVER (PARTITION BY unit, symbol ORDER BY timestamp DESC) <= 500""",
    f"units AS ({sql_units(list(UNITS))})"))(
    lambda spark, sf_dir: series.newest_n(several_units(minutes(spark, sf_dir), list(UNITS)), 500)
)
UNIT_MS = " ".join(f"WHEN '{u.name}' THEN {u.ms}" for u in UNITS.values())
query("gaps", with_trades(f"""
    SELECT exchange, unit, symbol, previous, timestamp,
           epoch_ms(timestamp) - epoch_ms(previous) AS step_ms
    FROM (SELECT *, lag(timestamp) OVER (PARTITION BY unit, symbol ORDER BY timestamp) AS previous
          FROM units)
    WHERE step_ms <> CASE unit {UNIT_MS} END""",
    f"units AS ({sql_units(list(UNITS))})"))(
    lambda spark, sf_dir: series.gaps(several_units(minutes(spark, sf_dir), list(UNITS)))
)


def latest_of_trades(spark, sf_dir) -> DataFrame:
    """Newest 1m start per series, which the trades give without folding them."""
    newest = trades(spark, sf_dir).groupBy("exchange", "symbol").agg(F.max("timestamp").alias("t"))
    return newest.select(
        "exchange", F.lit("1m").alias("unit"), "symbol",
        bucket_start("t", "1m").alias("latest"),
    )


query("closed_flag", with_trades("""
    SELECT *, timestamp < max(timestamp) OVER (PARTITION BY symbol) AS closed FROM minutes""",
    f"minutes AS ({sql_candles('1m')})"))(
    lambda spark, sf_dir: series.with_closed(minutes(spark, sf_dir))
)
query("drop_unclosed", with_trades("""
    SELECT * FROM minutes
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) > 1""",
    f"minutes AS ({sql_candles('1m')})"))(
    lambda spark, sf_dir: series.drop_unclosed(minutes(spark, sf_dir))
)
query("oldest_candle", f"SELECT min({sql_bucket('1m', 'ts')}) AS timestamp FROM events")(
    lambda spark, sf_dir: series.oldest_timestamp(minutes(spark, sf_dir))
)
query("symbols", "SELECT DISTINCT upper(event_type) || '/KRW' AS symbol FROM events")(
    lambda spark, sf_dir: series.symbols(minutes(spark, sf_dir))
)
query("market_codes", "SELECT DISTINCT 'KRW-' || upper(event_type) AS code FROM events")(
    lambda spark, sf_dir: series.codes(export.to_export(minutes(spark, sf_dir)), "UPBIT")
)
query("candles_by_symbol", with_trades("""
    SELECT timestamp, symbol, open, high, low, close, volume FROM minutes
    WHERE symbol = 'CLICK/KRW' ORDER BY timestamp DESC LIMIT 990 OFFSET 10""",
    f"minutes AS ({sql_candles('1m')})"))(
    lambda spark, sf_dir: series.candles_by_symbol(
        minutes(spark, sf_dir), "upbit", "1m", "CLICK/KRW", since=10, limit=1000)
)

# ---- F13-F15, T8, K4, K7: export ------------------------------------------------------

EXPORTED_UNITS = list(UNITS)

for _exchange, _profile in (("upbit", SEQUENCE), ("bithumb", ARRIVAL)):
    query(f"export_{_exchange}", with_trades(sql_export("""(SELECT * FROM units
        QUALIFY row_number() OVER (PARTITION BY unit, symbol ORDER BY timestamp DESC) <= 2000)""",
        _exchange), f"units AS ({sql_units(EXPORTED_UNITS, exchange=_exchange)})"))(
        lambda spark, sf_dir, exchange=_exchange, profile=_profile: export.to_export(
            series.newest_n(several_units(
                fold_trades(trades(spark, sf_dir, exchange), profile=profile), EXPORTED_UNITS),
                2000))
    )

query("export_latest", with_trades(sql_export("latest"), "latest AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({sql_candles(u)}) WHERE timestamp >= TIMESTAMP '{lookback_start(NOW, u)}'"
    for u in UNITS) + ")"))(
    lambda spark, sf_dir: export.to_export(export.latest_buckets(
        several_units(minutes(spark, sf_dir), list(UNITS)), NOW))
)


def sql_expired(cutoffs: dict[str, int]) -> str:
    return " OR ".join(f"(unit = '{u}' AND tms < {ms})" for u, ms in cutoffs.items())


SQL_EXPIRED = sql_expired(export.retention_cutoffs(NOW))
SQL_EXPORTED = f"exported AS (SELECT * FROM ({sql_export('units')}))"
SQL_EXPORTED_UNITS = f"units AS ({sql_units(EXPORTED_UNITS)})"


def stored_export(spark, sf_dir) -> ExportTable:
    """An export store written twice: a lossy history, then the whole candles over it."""
    table = ExportTable(spark, shared_folder(spark, "export"))
    for version, source in enumerate((kept_trades(spark, sf_dir), trades(spark, sf_dir))):
        table.upsert(export.to_export(several_units(fold_trades(source), EXPORTED_UNITS)), version)
    return table


query("export_upsert", with_trades("SELECT * FROM exported", SQL_EXPORTED_UNITS, SQL_EXPORTED))(
    lambda spark, sf_dir: stored_export(spark, sf_dir).read()
)


@query("retention_keep", with_trades(
    f"SELECT * FROM exported WHERE NOT ({SQL_EXPIRED})", SQL_EXPORTED_UNITS, SQL_EXPORTED))
def retention_keep(spark, sf_dir):
    table = stored_export(spark, sf_dir)
    table.delete_expired(NOW)
    return table.read()


@query("retention_deleted", with_trades(
    f"SELECT unit, count(*) AS deleted FROM exported WHERE {SQL_EXPIRED} GROUP BY unit",
    SQL_EXPORTED_UNITS, SQL_EXPORTED))
def retention_deleted(spark, sf_dir):
    deleted = stored_export(spark, sf_dir).delete_expired(NOW)
    rows = [(unit, n) for unit, n in deleted.items() if n]
    return spark.createDataFrame(rows, "unit string, deleted long")

# ---- J1-J4, A8-A10, F19, L4: reconciliation -------------------------------------------

CHECKED_UNITS = list(UNITS)


def stored_and_served(spark, sf_dir, units=None) -> tuple[DataFrame, DataFrame]:
    units = units or CHECKED_UNITS
    return (
        several_units(fold_trades(kept_trades(spark, sf_dir)), units),
        several_units(minutes(spark, sf_dir), units),
    )


def stored_and_closed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    stored, served = stored_and_served(spark, sf_dir)
    return stored, compare.closed_on_grid(served)


def sql_sides(units: list[str], depths: dict[str, int] | None = None) -> list[str]:
    depth = ""
    if depths:
        cases = " ".join(f"WHEN '{u}' THEN {n}" for u, n in depths.items())
        depth = ("QUALIFY row_number() OVER (PARTITION BY unit, symbol ORDER BY timestamp DESC)"
                 f" <= CASE unit {cases} END")
    return [
        f"db AS (SELECT * FROM ({sql_units(units, f'amount <> {LOST_AMOUNT}')}) {depth})",
        f"served AS (SELECT * FROM ({sql_units(units)}) {depth})",
        """ex AS (SELECT * FROM served QUALIFY row_number() OVER (
             PARTITION BY unit, symbol ORDER BY timestamp DESC) > 1)""",
        """compared AS (
      SELECT exchange, unit, symbol, timestamp, db.close AS db_close,
             ex.close AS exchange_close, db.open IS NOT NULL AS in_db,
             ex.open IS NOT NULL AS in_ex, db.open <> ex.open AS o, db.high <> ex.high AS h,
             db.low <> ex.low AS l, db.close <> ex.close AS c,
             printf('%.4f', abs(db.volume - ex.volume))::DOUBLE AS vd, vd >= 0.1 AS v,
             in_ex AND (NOT in_db OR o OR h OR l OR c OR v) AS is_diff
      FROM ex FULL OUTER JOIN db USING (exchange, unit, symbol, timestamp))""",
    ]


SQL_DIFFS = """SELECT exchange, unit, symbol, epoch_ms(timestamp) AS tms, timestamp AS date,
  db_close, exchange_close, o AS open, h AS high, l AS low, c AS close, v AS volume,
  vd AS volume_delta
  FROM compared WHERE is_diff"""
SQL_SUMMARY = """SELECT exchange, unit, symbol, count(*) FILTER (in_db) AS db_count,
  count(*) FILTER (in_ex) AS exchange_count, count(*) FILTER (is_diff) AS diff_count,
  count(*) FILTER (is_diff AND o) AS open_diff_count,
  count(*) FILTER (is_diff AND h) AS high_diff_count,
  count(*) FILTER (is_diff AND l) AS low_diff_count,
  count(*) FILTER (is_diff AND c) AS close_diff_count,
  count(*) FILTER (is_diff AND v) AS volume_diff_count,
  count(*) FILTER (is_diff AND NOT in_db) AS gap_count,
  0 AS created_at_diff_count, max(vd) FILTER (is_diff) AS max_volume_diff
  FROM compared GROUP BY exchange, unit, symbol HAVING diff_count > 0"""
# Stored 1m candles were all written long after their minute; other units have no such time.
SQL_STORED_SUMMARY = (
    SQL_SUMMARY.replace("0 AS created_at_diff_count", """CASE unit WHEN '1m' THEN
      count(*) FILTER (in_db) ELSE 0 END AS created_at_diff_count, CASE unit """ + " ".join(
        f"WHEN '{u}' THEN {n}" for u, n in CHECK_DEPTHS["upbit"].items()) + " END AS check_count")
    .replace("diff_count > 0", "diff_count > 0 OR created_at_diff_count > 0")
)


@query("reconcile_diff", with_trades(SQL_DIFFS, *sql_sides(CHECKED_UNITS)))
def reconcile_diff(spark, sf_dir):
    diffs = compare.reconcile_diffs(*stored_and_closed(spark, sf_dir))
    return diffs.select(
        "exchange", "unit", "symbol", "tms", "date", F.col("db_candle.close").alias("db_close"),
        F.col("exchange_candle.close").alias("exchange_close"),
        "open", "high", "low", "close", "volume", "volume_delta",
    )


query("reconcile_summary", with_trades(SQL_SUMMARY, *sql_sides(CHECKED_UNITS)))(
    lambda spark, sf_dir: compare.reconcile_summary(*stored_and_closed(spark, sf_dir))
)


# The same rows from digests: whole sides are aggregated, candles of differing blocks alone are joined.
@query("reconcile_by_digest", with_trades(SQL_SUMMARY, *sql_sides(CHECKED_UNITS)))
def reconcile_by_digest(spark, sf_dir):
    stored, served = (written(side, "side") for side in stored_and_closed(spark, sf_dir))
    blocks = written(digest.compared_blocks(stored, served), "blocks")
    return digest.summary_by_digest(digest.flagged_pairs(stored, served, blocks), blocks)


@query("reconcile_blocks", with_trades("""
    SELECT exchange, unit, symbol, CASE WHEN unit LIKE '%m' THEN date_trunc('day', timestamp)
             WHEN unit LIKE '%h' THEN date_trunc('month', timestamp)
             ELSE date_trunc('year', timestamp) END AS block,
           count(db.open) AS db_count, count(ex.open) AS exchange_count, bool_or(db.open IS NULL OR ex.open IS NULL
             OR db.open <> ex.open OR db.high <> ex.high OR db.low <> ex.low OR db.close <> ex.close
             OR db.volume <> ex.volume) AS differs
    FROM ex FULL OUTER JOIN db USING (exchange, unit, symbol, timestamp) GROUP BY ALL""",
    *sql_sides(CHECKED_UNITS)[:3]))
def reconcile_blocks(spark, sf_dir):
    blocks = digest.compared_blocks(*stored_and_closed(spark, sf_dir)).drop("created_at_diff_count")
    return blocks.withColumn("block", F.col("block").cast("timestamp_ntz"))


@query("reconcile_depths", with_trades(
    SQL_STORED_SUMMARY, *sql_sides(list(CHECK_DEPTHS["upbit"]), CHECK_DEPTHS["upbit"])))
def reconcile_depths(spark, sf_dir):
    """The job over a table that the cascade filled."""
    table = filled_table(spark, sf_dir)
    served = several_units(minutes(spark, sf_dir), list(CHECK_DEPTHS["upbit"]))
    return reconcile(table, served, CHECK_DEPTHS)


def filled_table(spark, sf_dir) -> CandleTable:
    table = CandleTable(spark, shared_folder(spark, "stored"))
    table.upsert(fold_trades(kept_trades(spark, sf_dir)))
    fill_table(table)
    return table


# The report of the job, written and read back.
@query("report_diffs", with_trades(
    "SELECT exchange, unit, replace(symbol, '/', '_') AS symbol, epoch_ms(timestamp) AS tms,"
    " o AS open, c AS close, vd AS volume_delta FROM compared WHERE is_diff",
    *sql_sides(list(CHECK_DEPTHS["upbit"]), CHECK_DEPTHS["upbit"])))
def report_diffs(spark, sf_dir):
    path = shared_folder(spark, "report")
    served = several_units(minutes(spark, sf_dir), list(CHECK_DEPTHS["upbit"]))
    reconcile(filled_table(spark, sf_dir), served, CHECK_DEPTHS, report_path=path)
    schema = "tms long, open boolean, close boolean, volume_delta double, exchange string, unit string, symbol string"
    return spark.read.schema(schema).json(f"{path}/diffs")


SQL_BOTH = [
    f"{side}.{name} AS {long}_{name}" for side, long in (("db", "db"), ("ex", "exchange"))
    for name in ("open", "high", "low", "close", "volume")
]


# Every difference of the report with both candles; a candle that only the exchange has has no flags.
@query("report_candles", with_trades(f"""
    SELECT exchange, unit, replace(symbol, '/', '_') AS symbol, epoch_ms(timestamp) AS tms,
           timestamp AS date, {', '.join(SQL_BOTH)}, db.open <> ex.open AS open, db.high <> ex.high AS high,
           db.low <> ex.low AS low, db.close <> ex.close AS close,
           printf('%.4f', abs(db.volume - ex.volume))::DOUBLE >= 0.1 AS volume
    FROM ex LEFT JOIN db USING (exchange, unit, symbol, timestamp)
    WHERE db.open IS NULL OR db.open <> ex.open OR db.high <> ex.high OR db.low <> ex.low
      OR db.close <> ex.close OR printf('%.4f', abs(db.volume - ex.volume))::DOUBLE >= 0.1""",
    *sql_sides(list(CHECK_DEPTHS["upbit"]), CHECK_DEPTHS["upbit"])[:3]))
def report_candles(spark, sf_dir):
    path = shared_folder(spark, "report")
    served = several_units(minutes(spark, sf_dir), list(CHECK_DEPTHS["upbit"]))
    reconcile(filled_table(spark, sf_dir), served, CHECK_DEPTHS, report_path=path)
    names = ("open", "high", "low", "close", "volume")
    candle = "struct<" + ", ".join(f"{name}: double" for name in names) + ">"
    schema = ("exchange string, unit string, symbol string, tms long, date timestamp_ntz, "
              f"db_candle {candle}, exchange_candle {candle}, "
              + ", ".join(f"{name} boolean" for name in names))
    report = spark.read.schema(schema).json(f"{path}/diffs")
    return report.select(
        "exchange", "unit", "symbol", "tms", "date", *names,
        *[F.col(f"{side}_candle.{name}").alias(f"{side}_{name}") for side in ("db", "exchange") for name in names],
    )


# The summary file of the report.
@query("report_summary", with_trades(
    SQL_STORED_SUMMARY, *sql_sides(list(CHECK_DEPTHS["upbit"]), CHECK_DEPTHS["upbit"])))
def report_summary(spark, sf_dir):
    path = shared_folder(spark, "report")
    served = several_units(minutes(spark, sf_dir), list(CHECK_DEPTHS["upbit"]))
    summary = reconcile(filled_table(spark, sf_dir), served, CHECK_DEPTHS, report_path=path)
    return spark.read.schema(summary.schema).json(f"{path}/summary")


# A minute keeps the time of its first write, whatever is written later.
@query("created_of_minutes", with_trades(f"""
    SELECT timestamp, symbol, open, high, low, close, volume, last_trade + INTERVAL {CREATED_DELAY_S} SECOND AS created_at
    FROM ({sql_candles('1m')}) JOIN (
      SELECT symbol, {sql_bucket('1m')} AS timestamp, max(timestamp) AS last_trade FROM trades GROUP BY ALL
    ) USING (symbol, timestamp) WHERE symbol = 'CLICK/KRW'"""))
def created_of_minutes(spark, sf_dir):
    table = CandleTable(spark, shared_folder(spark, "created"))
    candles = fold_trades(trades(spark, sf_dir), details=True)
    first = F.col("last_trade") + F.expr(f"INTERVAL {CREATED_DELAY_S} SECONDS")
    table.upsert(candles.withColumn("open", F.lit(0.0)).withColumn("created_at", first))
    table.upsert(candles.withColumn("created_at", first + F.expr("INTERVAL 1 HOUR")))
    rows = table.candles(exchange="upbit", units=["1m"], symbol="CLICK/KRW")
    return rows.select("timestamp", "symbol", "open", "high", "low", "close", "volume", "created_at")


@query("created_lag", with_trades(f"""
    SELECT exchange, symbol, start AS timestamp,
           abs(epoch_ms(start) - epoch_ms(last_trade + INTERVAL {CREATED_DELAY_S} SECOND)) > 61000
             AS created_diff
    FROM (SELECT exchange, symbol, {sql_bucket('1m')} AS start, max(timestamp) AS last_trade
          FROM trades GROUP BY ALL)"""))
def created_lag(spark, sf_dir):
    candles = fold_trades(trades(spark, sf_dir), details=True)
    delay = F.expr(f"INTERVAL {CREATED_DELAY_S} SECONDS")
    stamped = candles.withColumn("created_at", F.col("last_trade") + delay)
    return compare.with_created_lag(stamped).select("exchange", "symbol", "timestamp", "created_diff")


CSV_UNITS = list(UNITS)


# Marks of the rows that differ, among those that both sides have.
@query("export_marks", with_trades("""
    SELECT unit, code, make_timestamp(tms * 1000) AS date, tms,
           if(o, 'o', 'x') AS open, if(h, 'o', 'x') AS high, if(l, 'o', 'x') AS low,
           if(c, 'o', 'x') AS close, if(v, 'o', 'x') AS volume,
           o OR h OR l OR c AS is_price, v AS is_volume, if(v, vd, 0) AS volume_diff
    FROM (SELECT unit, code, tms, d.op <> r.op AS o, d.hp <> r.hp AS h, d.lp <> r.lp AS l,
                 d.cp <> r.cp AS c, printf('%.4f', d.tv) <> printf('%.4f', r.tv) AS v,
                 abs(d.tv - r.tv) AS vd
          FROM stored d JOIN rest r USING (unit, code, tms))
    WHERE o OR h OR l OR c OR v""",
    *sql_sides(CSV_UNITS), f"stored AS ({sql_export('db')})", f"rest AS ({sql_export('served')})"))
def export_marks(spark, sf_dir):
    stored, served = stored_and_served(spark, sf_dir, CSV_UNITS)
    rest = history.rest_to_export(rest_rows(served, page=1))
    return compare.export_diff_rows(compare.export_flags(export.to_export(stored), rest))


@query("reconcile_csv", with_trades("""
    SELECT code, lower(unit) AS candle, count(*) FILTER (p OR v) AS diff_count,
           printf('%.2f', count(*) FILTER (p OR v) / 1000 * 100)::DOUBLE AS diff_percent,
           count(*) FILTER (p) AS price_diff_count, count(*) FILTER (v) AS volume_diff_count,
           printf('%.2f', coalesce(max(vd), 0))::DOUBLE AS max_volume_diff,
           make_timestamp((arg_max(tms, (vd, tms)) FILTER (vd > 0)) * 1000) AS max_volume_diff_date
    FROM (SELECT d.code, d.unit, d.tms,
                 coalesce(d.op <> r.op OR d.hp <> r.hp OR d.lp <> r.lp OR d.cp <> r.cp, false) AS p,
                 coalesce(printf('%.4f', d.tv) <> printf('%.4f', r.tv), false) AS v,
                 CASE WHEN v THEN abs(d.tv - r.tv) END AS vd
          FROM newest d LEFT JOIN rest r USING (unit, code, tms)) GROUP BY code, unit""",
    *sql_sides(CSV_UNITS),
    """newest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
         PARTITION BY unit, code ORDER BY tms DESC) AS rn FROM (""" + sql_export("db") +
    ")) WHERE rn BETWEEN 2 AND 1001)",
    f"rest AS ({sql_export('served')})"))
def reconcile_csv(spark, sf_dir):
    stored, served = stored_and_served(spark, sf_dir, CSV_UNITS)
    table = ExportTable(spark, shared_folder(spark, "export"))
    table.upsert(export.to_export(stored))
    names = [UNITS[unit].export_name for unit in CSV_UNITS]
    rest = history.rest_to_export(rest_rows(served, page=1))
    return reconcile_export(table, rest, "UPBIT", names, 1000)


# The CSV report, written and read back.
@query("report_csv", with_trades(
    "SELECT code, lower(unit) AS candle, count(*)::VARCHAR AS rows FROM newest GROUP BY code, unit",
    *sql_sides(CSV_UNITS),
    """newest AS (SELECT * FROM (SELECT *, row_number() OVER (
         PARTITION BY unit, code ORDER BY tms DESC) AS rn FROM (""" + sql_export("db") +
    ")) WHERE rn BETWEEN 2 AND 1001)"))
def report_csv(spark, sf_dir):
    stored, _ = stored_and_served(spark, sf_dir, CSV_UNITS)
    table = ExportTable(spark, shared_folder(spark, "export"))
    table.upsert(export.to_export(stored))
    names = [UNITS[unit].export_name for unit in CSV_UNITS]
    # Against candles whose prices are all one higher, every row differs.
    rest = history.rest_to_export(rest_rows(stored.withColumn("open", F.col("open") + 1), page=1))
    path = shared_folder(spark, "report")
    write_csv_summary(compare.export_summary(table.newest_closed("UPBIT", names, 1000), rest), path)
    report = spark.read.option("header", True).csv(path)
    return report.select("code", "candle", F.col("diffCount").alias("rows"))


# All columns of the report, as the job writes them.
SQL_CSV_TEXT = """SELECT code, candle, diff_count::VARCHAR AS diffCount,
  printf('%.2f', diff_percent) AS diffPercent, price_diff_count::VARCHAR AS priceDiffCount,
  volume_diff_count::VARCHAR AS volumeDiffCount, printf('%.2f', max_volume_diff) AS maxVolumeDiff,
  strftime(max_volume_diff_date, '%Y-%m-%dT%H:%M:%S.%gZ') AS maxVolumeDiffDate
  FROM (SELECT * FROM summary)"""


@query("report_csv_columns", "SELECT * FROM (" + SQL_CSV_TEXT.replace(
    "(SELECT * FROM summary)", f"({ORACLE_SQL['reconcile_csv']})") + ")")
def report_csv_columns(spark, sf_dir):
    stored, served = stored_and_served(spark, sf_dir, CSV_UNITS)
    table = ExportTable(spark, shared_folder(spark, "export"))
    table.upsert(export.to_export(stored))
    names = [UNITS[unit].export_name for unit in CSV_UNITS]
    rest = history.rest_to_export(rest_rows(served, page=1))
    path = shared_folder(spark, "report")
    reconcile_export(table, rest, "UPBIT", names, 1000, report_path=path)
    return spark.read.option("header", True).csv(path)


# ---- T1-T7: streams -------------------------------------------------------------------


def drained(spark, candles: DataFrame, mode: str = "update") -> DataFrame:
    """Runs a stream over what is there into a table and reads the table."""
    table = CandleTable(spark, shared_folder(spark, "stream"))
    table.create()
    checkpoint = shared_folder(spark, "progress")
    live.upsert_stream(candles, table, checkpoint, mode=mode, every=None).awaitTermination()
    return table.read().drop("created_at")


def sql_closed(unit: str) -> str:
    """A candle is final once the watermark, a minute behind the newest trade, passes its end."""
    return f"""SELECT * FROM ({sql_candles(unit)})
      WHERE timestamp + INTERVAL '{SQL_INTERVALS[unit]}' <= (
        SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 MINUTE FROM events)"""


# Several micro-batches; the last one also brings every trade of the first day once more, with
# other ids and prices: far too late to change a candle.
@query("stream_candles_1m", with_trades(sql_candles("1m")))
def stream_candles_1m(spark, sf_dir):
    return drained(spark, live.candle_stream(with_late(spark, sf_dir)))


def with_late(spark, sf_dir) -> DataFrame:
    """Trades as a stream whose last batch also brings the first day's once more."""
    whole = trades(spark, sf_dir)
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    first_day = whole.agg(F.min("timestamp")).first()[0].date()
    late = whole.where(F.col("timestamp").cast("date") == F.lit(first_day)).select(
        *[(F.col(c) + 1_000_000_000 if c in ("id", "price") else F.col(c)).alias(c) for c in whole.columns],
        F.lit(2**62).alias("landed_at"),
    )
    path = landed(spark, whole.withColumn("landed_at", at).unionByName(late), "landed_at")
    return trade_source.stream_trades(spark, path, max_files=FILES)


# Every trade is in a candle or among the late ones: what the watermark would drop is kept.
@query("stream_late_rows", """
    SELECT event_id AS id, false AS late FROM events UNION ALL
    SELECT event_id + 1000000000, true FROM events WHERE ts::DATE = (SELECT min(ts)::DATE FROM events)""")
def stream_late_rows(spark, sf_dir):
    landing, progress = shared_folder(spark, "landing"), shared_folder(spark, "progress")
    table = CandleTable(spark, shared_folder(spark, "stream"))
    stream_candles_and_late(
        spark, with_late(spark, sf_dir), "upbit", table, landing, progress, every=None
    )[1].awaitTermination()
    return landed_trades(spark, landing).select("id", "late")


# The candles of the same stream: the late trades have changed none.
@query("stream_in_time_1m", with_trades(sql_candles("1m")))
def stream_in_time_1m(spark, sf_dir):
    landing, progress = shared_folder(spark, "landing"), shared_folder(spark, "progress")
    table = CandleTable(spark, shared_folder(spark, "stream"))
    stream_candles_and_late(
        spark, with_late(spark, sf_dir), "upbit", table, landing, progress, every=None
    )[1].awaitTermination()
    return table.read().drop("created_at")


# Every seventh trade of all but the last week arrives after the cascade; only the candles that it
# belongs to are computed again, and all units equal a full fold.
@query("late_repair", with_trades(sql_units(list(UNITS))))
def late_repair(spark, sf_dir):
    whole = trades(spark, sf_dir)
    last = whole.agg(F.max("timestamp") - F.expr("INTERVAL 7 DAYS")).first()[0]
    is_late = (F.col("id") % 7 == 0) & (F.col("timestamp") < F.lit(last))
    store = shared_folder(spark, "trades")
    append_trades(whole.where(~is_late), store)
    table = CandleTable(spark, shared_folder(spark, "repaired"))
    table.upsert(fold_trades(spark.read.parquet(store)))
    fill_table(table)
    append_trades(whole.where(is_late), store)
    repair(table, whole.where(is_late), spark.read.parquet(store), "upbit")
    return table.read().drop("created_at")


query("stream_closed_1m", with_trades(sql_closed("1m")))(
    lambda spark, sf_dir: drained(
        spark, live.candle_stream(event_stream(spark, sf_dir)), mode="append")
)
query("stream_chain_1d", with_trades(sql_closed("1d")))(
    lambda spark, sf_dir: drained(
        spark, live.chained_candle_stream(event_stream(spark, sf_dir), ["1m", "1h", "1d"]),
        mode="append")
)
# Every trade is sent twice, some of them in two batches.
query("stream_dedup", with_trades(sql_candles("1m")))(
    lambda spark, sf_dir: drained(spark, live.candle_stream(trade_stream(
        spark, trades(spark, sf_dir).unionByName(trades(spark, sf_dir)))))
)


def bithumb_messages(spark, sf_dir) -> DataFrame:
    """Messages of two trades in one millisecond each, with their offset."""
    def record(pos: int) -> Column:
        return F.struct(
            F.concat(F.upper("event_type"), F.lit("_KRW")).alias("symbol"),
            F.lit("1").alias("buySellGb"), (F.col("value") + pos).cast("string").alias("contPrice"),
            F.get_json_object("props", "$.k").alias("contQty"), F.lit("1").alias("contAmt"),
            F.date_format(F.col("ts") + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd H:mm:ss.SSSSSS").alias("contDtm"),
        )

    content = F.struct(F.array(record(0), record(1)).alias("list"))
    message = F.struct(F.lit("transaction").alias("type"), content.alias("content"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.to_json(message).alias("value"), epoch_ms("ts").alias("landed_at")
    )


# From messages to candles: trades of one millisecond keep the order of their arrival.
@query("stream_bithumb_1m", f"""
    WITH trades AS (
      SELECT 'bithumb' AS exchange, upper(event_type) || '/KRW' AS symbol,
             date_trunc('milliseconds', ts) AS timestamp, value + pos AS price,
             json_extract_string(props, '$.k')::DOUBLE AS amount, event_id * 2 + pos AS id
      FROM events, (VALUES (0), (1)) AS positions(pos))
    {sql_candles('1m', exchange='bithumb')}""")
def stream_bithumb_1m(spark, sf_dir):
    rows = spark.read.parquet(landed(spark, bithumb_messages(spark, sf_dir), "landed_at"))
    path = shared_folder(spark, "messages")
    rows.write.json(path)
    messages = trade_source.stream_ordered_messages(spark, path)
    found = trade_source.trades_from_batches(messages)
    return drained(spark, live.candle_stream(found, profile=ARRIVAL))


# The table holds every trade up to the middle of each symbol's newest minute; the stream brings
# the rest in two runs, the second of which restarts from the checkpoint.
@query("stream_seeded", with_trades(sql_candles("1m")))
def stream_seeded(spark, sf_dir):
    whole = trades(spark, sf_dir)
    newest = latest_of_trades(spark, sf_dir).select("exchange", "symbol", "latest")
    cut = F.col("latest") + F.expr("INTERVAL 30 SECONDS")
    marked = whole.join(newest, ["exchange", "symbol"])
    table = CandleTable(spark, shared_folder(spark, "stored"))
    table.upsert(fold_trades(marked.where(F.col("timestamp") < cut).select(*whole.columns)))
    rest = marked.where(F.col("timestamp") >= cut).select(*whole.columns)
    path, checkpoint = shared_folder(spark, "landed"), shared_folder(spark, "progress")
    for part in range(2):
        mine = F.pmod(F.hash("symbol"), F.lit(2)) == part
        rest.where(mine).write.mode("append").parquet(path)
        stream_candles(
            spark, trade_source.stream_trades(spark, path), "upbit", table, checkpoint, every=None,
            # Symbols of these tables end days apart.
            lateness="40 days",
        ).awaitTermination()
    return table.candles(units=["1m"]).drop("created_at")


SQL_SYMBOL_CLOSE = """
    SELECT *, timestamp < max(timestamp) OVER (PARTITION BY symbol) AS closed FROM minutes"""


def closed_by_symbol(spark, stream: DataFrame, profile=SEQUENCE) -> DataFrame:
    path, checkpoint = shared_folder(spark, "closing"), shared_folder(spark, "progress")
    closing_stream(stream, path, checkpoint, profile=profile, every=None).awaitTermination()
    return current_candles(spark.read.parquet(f"{path}/revisions"))


# Each symbol closes by its own newest bucket; one symbol arrives six hours behind the others,
# and every trade is sent twice.
@query("stream_symbol_close", with_trades(SQL_SYMBOL_CLOSE, f"minutes AS ({sql_candles('1m')})"))
def stream_symbol_close(spark, sf_dir):
    whole = trades(spark, sf_dir)
    late = F.when(F.col("symbol") == "CLICK/KRW", F.lit(6 * 3_600_000)).otherwise(F.lit(0))
    stream = trade_stream(spark, whole.unionByName(whole), epoch_ms("timestamp") + late)
    return closed_by_symbol(spark, stream)


# The same for trades that have no ids of their own: two in one millisecond are two.
@query("stream_symbol_close_arrival", with_trades(
    SQL_SYMBOL_CLOSE, f"""minutes AS (SELECT * REPLACE (volume * 2 AS volume) FROM (
      {sql_candles('1m', exchange='bithumb')}))"""))
def stream_symbol_close_arrival(spark, sf_dir):
    whole = trades(spark, sf_dir, "bithumb").withColumn("id", epoch_ms("timestamp"))
    twin = whole.withColumn("arrival_pos", F.lit(1))
    return closed_by_symbol(spark, trade_stream(spark, whole.unionByName(twin)), ARRIVAL)


# Every tenth trade comes in a second batch. Those of minutes that their symbol has closed by then are kept
# as late trades, and with the trades in candles they add up to all trades.
@query("stream_symbol_late", with_trades("""
    SELECT exchange, symbol, timestamp, price, amount, id, 'late' AS fate FROM placed WHERE late
    UNION ALL
    SELECT exchange, symbol, timestamp, NULL, volume, -1, 'candle' FROM (
      SELECT exchange, symbol, minute AS timestamp, sum(amount) AS volume FROM placed
      WHERE NOT late GROUP BY ALL)""", """
    minutes AS (SELECT *, date_trunc('minute', timestamp) AS minute FROM trades),
    opened AS (SELECT symbol, max(minute) AS opened FROM minutes WHERE id % 10 <> 0 GROUP BY symbol),
    placed AS (
      SELECT minutes.*, id % 10 = 0 AND coalesce(minute < opened, false) AS late
      FROM minutes LEFT JOIN opened USING (symbol))"""))
def stream_symbol_late(spark, sf_dir):
    whole = trades(spark, sf_dir)
    path = landed(spark, whole.withColumn("second", (F.col("id") % 10 == 0).cast("int")), "second", 2)
    out, checkpoint = shared_folder(spark, "closing"), shared_folder(spark, "progress")
    stream = trade_source.stream_trades(spark, path, max_files=FILES)
    closing_stream(stream, out, checkpoint, every=None).awaitTermination()
    late = late_trades(spark, out).select(
        "exchange", "symbol", "timestamp", "price", "amount", "id", F.lit("late").alias("fate"))
    candles = current_candles(spark.read.parquet(f"{out}/revisions")).select(
        "exchange", "symbol", "timestamp", F.lit(None).cast("double").alias("price"),
        F.col("volume").alias("amount"), F.lit(-1).cast("long").alias("id"), F.lit("candle").alias("fate"))
    return late.unionByName(candles)
