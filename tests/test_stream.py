import time
from datetime import datetime, timedelta

import pytest

from candlewick.operators.fold import ARRIVAL, fold_trades
from candlewick.plans import jobs
from candlewick.sources.tables import CandleTable
from candlewick.sources.trades import stream_messages, stream_trades, trades_from_singles
from candlewick.streaming import candles as live
from candlewick.streaming.closing import closing_stream, current_candles, late_trades
from test_fold import as_dict, random_rows


@pytest.fixture
def landing(make_trades, tmp_path):
    """Lands row lists as files that stream in order, one per micro-batch."""
    folder = tmp_path / "landed"
    folder.mkdir()

    def land(*batches):
        for rows in batches:
            n = len(list(folder.glob("*.parquet")))
            frame = make_trades(rows).toPandas()
            frame["timestamp"] = frame["timestamp"].astype("datetime64[us]")
            frame.to_parquet(folder / f"{n:04}.parquet")
        return str(folder)

    return land


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def table_at(spark, path):
    table = CandleTable(spark, str(path))
    table.create()
    return table


def batches_of(rows, size=60):
    rows = sorted(rows)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_updates_equal_batch_and_restart(spark, landing, make_trades, tmp_path):
    rows = random_rows(11)
    batches = batches_of(rows)
    folder = landing(*batches[:3])
    table = table_at(spark, tmp_path / "candles")

    def run():
        trades = stream_trades(spark, folder, max_files=1)
        query = jobs.stream_candles(spark, trades, "upbit", table, str(tmp_path / "progress"), every=None)
        drain(query)

    run()
    assert as_dict(table.candles()) == as_dict(
        fold_trades(make_trades([r for b in batches[:3] for r in b])))
    landing(*batches[3:])
    run()
    assert as_dict(table.candles()) == as_dict(fold_trades(make_trades(rows)))


def minute(n, second=0):
    return (datetime(2024, 1, 15) + timedelta(minutes=n, seconds=second)).isoformat()


def test_closed_candles_and_late_trades(spark, landing, tmp_path):
    folder = landing(
        [(minute(0), "A/KRW", 10, 1, 1)],
        [(minute(5), "A/KRW", 20, 1, 2)],
        [(minute(5, 1), "A/KRW", 21, 1, 4)],
        [(minute(0, 30), "A/KRW", 99, 1, 3)],
        [(minute(9), "A/KRW", 30, 1, 5)],
    )
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    late = live.LateTrades()
    spark.streams.addListener(late)
    query = live.append_stream(
        live.candle_stream(stream_trades(spark, folder, max_files=1)), out, progress, every=None)
    drain(query)
    deadline = time.time() + 30
    while not late.dropped.get(str(query.id)) and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(late)
    closed = as_dict(spark.read.parquet(out))
    # The late trade does not reopen minute 0, and the newest candle is still open.
    assert closed == {
        ("A/KRW", datetime(2024, 1, 15)): (10, 10, 10, 10, 1),
        ("A/KRW", datetime(2024, 1, 15, 0, 5)): (20, 21, 20, 21, 2),
    }
    assert late.dropped[str(query.id)] >= 1


def test_repeats_across_batches(spark, landing, make_trades, tmp_path):
    rows = [(minute(0, s), "A/KRW", 10 + s, 0.25, s) for s in range(20)]
    folder = landing(rows, rows[10:], rows[:15])
    table = table_at(spark, tmp_path / "candles")
    drain(live.upsert_stream(
        live.candle_stream(stream_trades(spark, folder, max_files=1)), table,
        str(tmp_path / "progress"), every=None))
    assert as_dict(table.candles()) == as_dict(fold_trades(make_trades(rows)))


def test_arrival_profile(spark, landing, make_trades, tmp_path):
    rows = [(minute(0, 1), "A/KRW", 5, 1, 2), (minute(0, 1), "A/KRW", 6, 1, 1), (minute(0, 1), "A/KRW", 7, 1, 3)]
    folder = landing(rows)
    table = table_at(spark, tmp_path / "candles")
    drain(live.upsert_stream(
        live.candle_stream(stream_trades(spark, folder), profile=ARRIVAL), table,
        str(tmp_path / "progress"), every=None))
    assert as_dict(table.candles()) == {("A/KRW", datetime(2024, 1, 15)): (6, 7, 5, 7, 3)}


def test_cold_start_continues_stored_candle_and_restarts(spark, landing, make_trades, tmp_path):
    before = [(minute(0), "A/KRW", 1, 1, 1), (minute(3, 5), "A/KRW", 50, 2, 2), (minute(3, 9), "B/KRW", 7, 1, 3)]
    after = [(minute(3, 20), "A/KRW", 40, 3, 4), (minute(4), "B/KRW", 8, 1, 5)]
    more = [(minute(3, 30), "A/KRW", 45, 1, 6)]
    table = table_at(spark, tmp_path / "candles")
    table.upsert(fold_trades(make_trades(before)))

    def run(folder):
        query = jobs.stream_candles(
            spark, stream_trades(spark, folder), "upbit", table, str(tmp_path / "progress"),
            every=None, lateness="5 minutes")
        drain(query)

    run(landing(after))
    assert as_dict(table.candles()) == as_dict(fold_trades(make_trades(before + after)))
    run(landing(more))
    run(landing())
    assert as_dict(table.candles()) == as_dict(fold_trades(make_trades(before + after + more)))


def test_chain_closes_hours(spark, landing, make_trades, tmp_path):
    rows = [(minute(n * 7), "A/KRW", n % 13, 1, n) for n in range(40)]
    folder = landing(*batches_of(rows, 10), [(minute(400), "A/KRW", 1, 1, 999)])
    out = str(tmp_path / "out")
    chained = live.chained_candle_stream(stream_trades(spark, folder, max_files=1), ["1m", "15m", "1h"])
    drain(live.append_stream(chained, out, str(tmp_path / "progress"), every=None))
    assert as_dict(spark.read.parquet(out)) == as_dict(fold_trades(make_trades(rows), "1h"))


def test_each_symbol_closes_by_itself(spark, landing, make_trades, tmp_path):
    folder = landing(
        [(minute(0, 1), "FAST/KRW", 1, 0.1, 1), (minute(0, 2), "SLOW/KRW", 5, 0.1, 2)],
        [(minute(0, 40), "SLOW/KRW", 6, 0.2, 3), (minute(1, 10), "FAST/KRW", 2, 0.1, 4),
         (minute(0, 50), "FAST/KRW", 3, 0.1, 5)],
        # Minute 0 of FAST is closed by now, so this trade is late; SLOW is still in minute 0.
        [(minute(0, 55), "FAST/KRW", 9, 0.1, 6), (minute(0, 56), "SLOW/KRW", 7, 0.3, 7),
         (minute(0, 56), "SLOW/KRW", 7, 0.3, 7)],
    )
    final = closed_by_symbol(spark, folder, tmp_path)
    start = datetime(2024, 1, 15)
    assert as_dict(final) == {
        ("FAST/KRW", start): (1, 3, 1, 3, 0.2), ("FAST/KRW", minute_at(1)): (2, 2, 2, 2, 0.1),
        ("SLOW/KRW", start): (5, 7, 5, 7, 0.6),
    }
    closed = {(r["symbol"], r["timestamp"]) for r in final.where("closed").collect()}
    assert closed == {("FAST/KRW", start)}
    late = late_trades(spark, str(tmp_path / "out")).collect()
    assert [(r["symbol"], r["price"], r["id"], r["batch"]) for r in late] == [("FAST/KRW", 9, 6, 2)]


def closed_by_symbol(spark, folder, tmp_path, **options):
    path = str(tmp_path / "out")
    drain(closing_stream(
        stream_trades(spark, folder, max_files=1), path, str(tmp_path / "progress"), every=None, **options))
    return current_candles(spark.read.parquet(f"{path}/revisions"))


def test_a_symbol_hours_behind_loses_nothing(spark, landing, make_trades, tmp_path):
    slow = [(minute(0, s), "SLOW/KRW", s + 1, 1, s) for s in range(4)]
    folder = landing(*[
        [row, (minute(90 * n), "FAST/KRW", 1, 1, 100 + n), slow[0]] for n, row in enumerate(slow)
    ])
    final = as_dict(closed_by_symbol(spark, folder, tmp_path))
    assert final["SLOW/KRW", datetime(2024, 1, 15)] == (1, 4, 1, 4, 4)


def test_trades_of_one_millisecond_without_ids_all_count(spark, landing, tmp_path):
    rows = [(minute(0, 1), "A/KRW", 5, 1, 7), (minute(0, 1), "A/KRW", 6, 1, 7)]
    folder = landing(rows, [(minute(0, 2), "A/KRW", 4, 1, 8)])
    final = as_dict(closed_by_symbol(spark, folder, tmp_path, profile=ARRIVAL))
    (candle,) = final.values()
    assert candle[4] == 3 and candle[3] == 4


def minute_at(n):
    return datetime(2024, 1, 15, 0, n)


def test_messages_to_trade_sink(spark, tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "a.json").write_text(
        '{"type":"trade","code":"KRW-BTC","trade_timestamp":1705305784301,"trade_price":5.5,'
        '"trade_volume":2.0,"ask_bid":"BID","sequential_id":1}\n{"status":"UP"}\n')
    trades = trades_from_singles(stream_messages(spark, str(folder), max_files=1))
    out = str(tmp_path / "trades")
    drain(live.trade_sink(trades, out, str(tmp_path / "progress"), every=None))
    (row,) = spark.read.parquet(out).collect()
    assert (row["symbol"], row["side"], row["created_at"].year >= 2024) == ("BTC/KRW", "buy", True)
