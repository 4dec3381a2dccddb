"""Late trades: the bound against Spark's own watermark, repeated batches, and repair."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from candlewick.__main__ import main
from candlewick.operators.fold import fold_trades
from candlewick.operators.rollup import rollup_all
from candlewick.plans import jobs
from candlewick.schemas import CANDLE_COLUMNS
from candlewick.sources.tables import CandleTable, append_trades
from candlewick.sources.trades import stream_trades
from candlewick.streaming import candles as live
from candlewick.streaming.late import land_batch, landed_trades, late_trades

START = datetime(2024, 1, 15)


def shuffled_trades(seed, count=300, spread=600):
    """(time, symbol, price, amount, id) in order of arrival, up to ten minutes out of order."""
    pick = random.Random(seed)
    order = sorted(range(count), key=lambda k: k * 20 + pick.random() * spread)
    return [((START + timedelta(seconds=k * 20)).isoformat(), f"{'AB'[k % 2]}/KRW", 1 + k, 1, k) for k in order]


def plain_late(batches, lateness):
    """Ids of trades not newer than the newest of the batches before less the lateness."""
    late, newest = set(), None
    for batch in batches:
        at = [datetime.fromisoformat(t[0]) for t in batch]
        if newest is not None:
            late |= {t[4] for t, when in zip(batch, at) if when <= newest - lateness}
        newest = max([*at, *([newest] if newest else [])])
    return late


def ids(rows):
    return {r["id"] for r in rows.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_late_and_in_time_add_up_and_no_more_are_dropped(spark, make_trades, tmp_path, seed):
    rows = shuffled_trades(seed)
    batches = [rows[k:k + 60] for k in range(0, len(rows), 60)]
    source, landing, checkpoint = (str(tmp_path / name) for name in ("source", "landing", "progress"))
    table = CandleTable(spark, str(tmp_path / "candles"))
    table.create()
    for batch in batches:
        make_trades(batch).coalesce(1).write.mode("append").parquet(source)
        counts = live.LateTrades()
        spark.streams.addListener(counts)
        jobs.stream_candles_and_late(
            spark, stream_trades(spark, source), "upbit", table, landing, checkpoint, every=None
        )[1].awaitTermination()
        spark.streams.removeListener(counts)
        assert sum(counts.dropped.values()) == 0
    want = plain_late(batches, timedelta(minutes=1))
    assert ids(late_trades(spark, landing)) == want and 0 < len(want) < len(rows)
    assert landed_trades(spark, landing).count() == len(rows)
    kept = make_trades([r for r in rows if r[4] not in want])
    stored = table.candles().select(*CANDLE_COLUMNS)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, fold_trades(kept).collect()))
    # Repaired, nothing is missing.
    main(["repair", "--candles", table.path, "--exchange", "upbit", "--landing", landing])
    whole = fold_trades(make_trades(rows))
    minutes = table.candles(units=["1m"]).select(*CANDLE_COLUMNS)
    assert sorted(map(tuple, minutes.collect())) == sorted(map(tuple, whole.collect()))


def test_a_repeated_batch_lands_once(spark, make_trades, tmp_path):
    path = str(tmp_path / "landing")
    rows = shuffled_trades(3)
    batches = [rows[:100], rows[100:200], [(None, "A/KRW", 1, 1, 900)][:0] + rows[200:]]
    for number in (0, 1, 1, 2, 2):
        land_batch(make_trades(batches[number]), number, path, "1 minute")
    landed = landed_trades(spark, path)
    assert Counter(r["id"] for r in landed.collect()) == Counter(r[4] for r in rows)
    assert ids(late_trades(spark, path)) == plain_late(batches, timedelta(minutes=1))
    assert ids(late_trades(spark, path, after=2)) == set()


@pytest.mark.parametrize("timezone", ["UTC", "KST"])
def test_repair_touches_what_late_trades_touch(spark, make_trades, tmp_path, timezone):
    pick = random.Random(4)
    rows = [((START + timedelta(minutes=pick.randrange(40 * 1440), seconds=pick.randrange(60))).isoformat(),
             f"{'AB'[k % 2]}/KRW", 1 + k % 17, 1, k) for k in range(600)]
    late = [r for r in rows if r[4] % 40 == 0 and r[1] == "A/KRW"]
    store = str(tmp_path / "trades")
    append_trades(make_trades([r for r in rows if r not in late]), store)
    table = CandleTable(spark, str(tmp_path / "candles"))
    table.upsert(fold_trades(spark.read.parquet(store)))
    jobs.rollup_all(table, timezone)
    untouched = table.candles().where("symbol = 'B/KRW'").select(*CANDLE_COLUMNS).collect()
    append_trades(make_trades(late), store)
    jobs.repair(table, make_trades(late), spark.read.parquet(store), "upbit", timezone)
    minutes = fold_trades(make_trades(rows))
    want = minutes.unionByName(rollup_all(minutes, timezone))
    assert sorted(map(tuple, table.candles().select(*CANDLE_COLUMNS).collect())) == sorted(map(tuple, want.collect()))
    again = table.candles().where("symbol = 'B/KRW'").select(*CANDLE_COLUMNS).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, untouched))


def test_no_late_trades(spark, make_trades, tmp_path):
    table = CandleTable(spark, str(tmp_path / "candles"))
    trades = make_trades(shuffled_trades(5, 20))
    table.upsert(fold_trades(trades))
    jobs.repair(table, trades.where("false"), trades, "upbit")
    assert table.candles().count() == fold_trades(trades).count()
    assert late_trades(spark, str(tmp_path / "nowhere")).count() == 0
