import json
from datetime import datetime, timedelta

from candlewick.operators.fold import fold_trades
from candlewick.plans import jobs
from candlewick.schemas import ARRAY_CANDLE, REST_CANDLE
from candlewick.sources import history
from candlewick.sources.tables import CandleTable
from candlewick.sources.trades import (
    quoted_in, read_trade_files, trades_from_batches, trades_from_singles,
)
from candlewick.functions.symbols import join_ids
from pyspark.sql import functions as F


def record(**changes):
    return {
        "symbol": "TEA_KRW", "buySellGb": "1", "contPrice": "318.5", "contQty": "6.4",
        "contAmt": "2038.40", "contDtm": "2031-07-10 06:14:41.500999", "updn": "up", **changes,
    }


def test_batched_messages(spark):
    messages = [
        (1, {"type": "transaction", "content": {"list": [
            record(), record(contDtm="2031-07-10 8:05:09.5", contQty="1,234.5", buySellGb="2"),
            record(contDtm="2031-07-10 08:05:09", symbol="A_B_KRW", contPrice="abc"),
            record(contDtm="broken")]}}),
        (2, {"type": "ticker", "content": {"list": [record()]}}),
        (3, {"type": "transaction", "content": {"list": []}}),
        (4, {"status": "0000"}),
    ]
    rows = [(seq, json.dumps(message)) for seq, message in messages] + [(5, "not json")]
    trades = trades_from_batches(spark.createDataFrame(rows, "seq long, value string"))
    first, second, third, fourth = trades.orderBy("arrival_seq", "arrival_pos").collect()
    assert first["timestamp"] == datetime(2031, 7, 9, 21, 14, 41, 500000)
    assert (first["symbol"], first["side"], first["price"], first["amount"], first["cost"]) == (
        "TEA/KRW", "buy", 318.5, 6.4, 2038.4)
    assert first["id"] == ms("2031-07-09 21:14:41.500")
    assert (second["side"], second["amount"]) == ("sell", 1234.5)
    assert second["timestamp"] == datetime(2031, 7, 9, 23, 5, 9, 500000)
    assert third["timestamp"] == datetime(2031, 7, 9, 23, 5, 9)
    assert (third["symbol"], third["price"]) == ("A/B_KRW", None)
    assert fourth["timestamp"] is None
    assert [(r["arrival_seq"], r["arrival_pos"]) for r in (first, second, third, fourth)] == [
        (1, 0), (1, 1), (1, 2), (1, 3)]


def test_a_list_of_any_length_keeps_its_order(spark):
    message = json.dumps({"type": "transaction", "content": {"list": [record()] * 3000}})
    rows = spark.createDataFrame([(2**62, message)], "seq long, value string")
    trades = trades_from_batches(rows)
    assert trades.agg(F.max("arrival_pos"), F.min("arrival_seq")).first() == (2999, 2**62)


def test_fraction_digits_of_local_times(spark):
    texts = ["2031-07-10 9:24:18.125039", "2031-07-10 09:24:18.8", "2031-07-10 09:24:18"]
    messages = [
        (i, json.dumps({"type": "transaction", "content": {"list": [record(contDtm=text)]}}))
        for i, text in enumerate(texts)
    ]
    trades = trades_from_batches(spark.createDataFrame(messages, "seq long, value string"))
    assert [r["timestamp"].microsecond for r in trades.orderBy("arrival_seq").collect()] == [
        125000, 800000, 0]


def test_single_messages(spark):
    messages = [
        {"type": "trade", "code": "KRW-BTC", "trade_timestamp": 1941484446125, "trade_price": 5.5,
         "trade_volume": 2.0, "ask_bid": "ASK", "sequential_id": 9021},
        {"status": "UP"},
    ]
    rows = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    (trade,) = trades_from_singles(rows).collect()
    assert trade["symbol"] == "BTC/KRW"
    assert trade["timestamp"] == datetime(1970, 1, 1) + timedelta(milliseconds=1941484446125)
    assert (trade["side"], trade["cost"], trade["id"]) == ("sell", 11, 9021)


def test_trade_files(spark, tmp_path):
    rows = [{
        "symbol": "BTC/KRW", "side": "sell", "price": 4100.0 + i, "amount": 0.5,
        "sequential_id": f"90210{i}", "timestamp": f"2031-07-09 21:14:0{i}.301999",
    } for i in range(3)]
    (tmp_path / "trades.json").write_text(json.dumps(rows))
    trades = read_trade_files(spark, str(tmp_path / "trades.json"))
    assert trades.first()["timestamp"] == datetime(2031, 7, 9, 21, 14, 0, 301000)
    candle = fold_trades(trades).first()
    assert (candle["open"], candle["close"], candle["volume"]) == (4100, 4102, 1.5)


def test_symbols(spark):
    row = spark.range(1).select(
        *[c.alias(n) for n, c in zip("ab", join_ids("upbit", F.lit("BTC"), F.lit("KRW")))],
        *[c.alias(n) for n, c in zip("cd", join_ids("bithumb", F.lit("BTC"), F.lit("KRW")))],
    ).first()
    assert tuple(row) == ("BTC/KRW", "KRW-BTC", "BTC/KRW", "BTC_KRW")
    symbols = spark.createDataFrame([("BTC/KRW",), ("BTC/USDT",), ("KRW/BTC",)], "symbol string")
    assert [r["symbol"] for r in quoted_in(symbols).collect()] == ["BTC/KRW"]


def ms(text):
    return int((datetime.fromisoformat(text) - datetime(1970, 1, 1)).total_seconds() * 1000)


def array_rows(spark):
    rows = [
        ("15m", "2024-01-15 00:15:00"), ("15m", "2024-01-15 00:15:42"), ("15m", "2024-01-15 00:16:00"),
        ("1d", "2024-01-15 00:00:00"), ("1M", "2024-01-01 00:00:00"), ("1w", "2024-01-15 00:00:00"),
    ]
    full = [
        ("bithumb", unit, "BTC/KRW", [float(ms(at)), 1.0, 4.0, 0.5, float(at[-2:]), 9.0]) for unit, at in rows
    ]
    return spark.createDataFrame(full, ARRAY_CANDLE)


def test_array_history(spark, tmp_path):
    rows = array_rows(spark)
    assert sorted(r["unit"] for r in history.candles_from_arrays(rows).collect()) == [
        "15m", "15m", "15m", "1d", "1w"]
    snapped = history.native_history(rows).collect()
    assert sorted((r["unit"], r["timestamp"].isoformat()) for r in snapped) == [
        ("15m", "2024-01-15T00:15:00"), ("1w", "2024-01-15T00:00:00")]
    assert {r["unit"]: r["close"] for r in snapped} == {"15m": 42.0, "1w": 0.0}
    assert [r["timestamp"].minute for r in history.misaligned_history(rows).collect()] == [16]
    table = CandleTable(spark, str(tmp_path / "candles"))
    jobs.load_history(rows.where("unit = '1w'"), table, native_grid=True)
    row = table.candles().first()
    assert (row["open"], row["high"], row["low"], row["close"], row["volume"]) == (1, 4, 0.5, 0, 9)


def test_history_pages_overlap(make_candles):
    def page(number, minutes, value):
        rows = [("3m", f"2024-01-15 00:{m:02}:00", "BTC/KRW", value, value, value, value, 1) for m in minutes]
        return make_candles(rows).drop("created_at").withColumn("page", F.lit(number))

    pages = page(1, range(30, 60, 3), 1).unionByName(page(2, range(0, 36, 3), 2))
    rows = history.history_from_pages(pages, since=1, limit=12).orderBy(F.desc("timestamp")).collect()
    assert [r["timestamp"].minute for r in rows] == list(range(54, 21, -3))
    assert [r["close"] for r in rows if r["timestamp"].minute in (30, 33)] == [2, 2]


def test_rest_candles(spark, tmp_path):
    objects = [
        {"market": "KRW-BTC", "unit": "15m", "page": page, "candle_date_time_utc": "2024-01-15T00:15:00",
         "opening_price": 1, "high_price": 3, "low_price": 1, "trade_price": page,
         "candle_acc_trade_volume": 2.5} for page in (2, 1)
    ]
    (tmp_path / "rest.json").write_text("\n".join(json.dumps(o) for o in objects))
    rows = spark.read.schema(REST_CANDLE).json(str(tmp_path / "rest.json"))
    (row,) = history.rest_to_export(rows).collect()
    assert (row["market"], row["tms"], row["cp"], row["tv"]) == ("UPBIT", ms("2024-01-15T00:15:00"), 2, 2.5)
    (candle,) = history.rest_to_candles(rows).collect()
    assert (candle["symbol"], candle["close"]) == ("BTC/KRW", 2)
