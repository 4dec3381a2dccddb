import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from fnmatch import fnmatch

import pytest
from pyspark.sql import functions as F

from candlewick.operators.export import retention_cutoffs, to_export
from candlewick.plans import jobs
from candlewick.operators.rollup import rollup_all
from candlewick.sources.tables import CandleTable, ExportTable, append_trades, years_from
from candlewick.units import DERIVED_UNITS, UNITS, lookback_start

NOW = datetime(2024, 2, 1, 0, 7, 30)


def minute_rows(count, value, start=datetime(2024, 1, 29), step=1):
    return [
        ("1m", (start + timedelta(minutes=i * step)).isoformat(), "BTC/KRW", value, value, value, value, 1)
        for i in range(count)
    ]


@pytest.fixture
def table(spark, tmp_path):
    made = CandleTable(spark, str(tmp_path / "candles"))
    made.create()
    return made


def contents(rows):
    return sorted((r["unit"], r["timestamp"], r["symbol"], r["close"]) for r in rows.collect())


def test_empty_table_reads_empty(table):
    assert table.candles().count() == 0


def test_the_highest_version_wins(table, make_candles):
    rng, expected = random.Random(1), {}
    order = [1, 2, 5, 3, 6, 4]
    for version in order:
        offset = rng.randrange(0, 15_000)
        rows = minute_rows(50, version, datetime(2024, 1, 20) + timedelta(minutes=offset % 300))
        rows += minute_rows(20, version, datetime(2024, 1, 28, 23, 50))
        keyed = {row[1]: row for row in rows}
        table.upsert(make_candles(list(keyed.values())), version)
        expected |= {at: max(float(version), expected.get(at, 0)) for at in keyed}
        stored = {r["timestamp"].isoformat(): r["close"] for r in table.candles().collect()}
        assert stored == expected and table.raw().count() == len(expected)


def test_writes_without_version_replace(table, make_candles):
    table.upsert(make_candles(minute_rows(4, 9)), version=9)
    table.upsert(make_candles(minute_rows(2, 1)))
    assert [r[3] for r in contents(table.candles())] == [1, 1, 9, 9]
    # A versioned row yields only to its own writer's versions.
    table.upsert(make_candles(minute_rows(4, 5)), version=5)
    assert [r[3] for r in contents(table.candles())] == [5, 5, 9, 9]
    table.upsert(make_candles(minute_rows(4, 6)), version=1, writer="other")
    assert [r[3] for r in contents(table.candles())] == [6] * 4


def test_a_repeated_batch_changes_nothing_newer(table, make_candles):
    batches = [make_candles(minute_rows(2 + k, 1 + k)) for k in range(3)]
    for k in (0, 1, 2, 1, 0, 2):
        table.upsert(batches[k], version=k, writer="stream")
    assert [r[3] for r in contents(table.candles())] == [3] * 4


def test_a_lagging_clock_loses_nothing(table, make_candles, monkeypatch):
    table.upsert(make_candles(minute_rows(3, 1)))
    real = time.time, time.time_ns
    monkeypatch.setattr(time, "time", lambda: real[0]() - 86_400)
    monkeypatch.setattr(time, "time_ns", lambda: real[1]() - 86_400 * 10**9)
    table.upsert(make_candles(minute_rows(2, 2)))
    assert [r[3] for r in contents(table.candles())] == [2, 2, 1]


def test_a_write_that_fails_leaves_the_table(table, make_candles):
    table.upsert(make_candles(minute_rows(3, 1)))
    bad = make_candles(minute_rows(3, 2)).withColumn("close", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        table.upsert(bad)
    assert [r[3] for r in contents(table.candles())] == [1] * 3


def test_only_touched_partitions_are_written(table, make_candles):
    table.upsert(make_candles(minute_rows(30, 1, step=24 * 60)))
    files = {f: os.path.getmtime(f) for f in table.raw().inputFiles() for f in [f.removeprefix("file://")]}
    table.upsert(make_candles(minute_rows(1, 2, datetime(2024, 2, 6))))
    kept = {f.removeprefix("file://") for f in table.raw().inputFiles()} & files.keys()
    gone = {f.split("/p=")[1][:10] for f in files.keys() - kept}
    assert gone == {"2024-02-05"} and all(os.path.getmtime(f) == files[f] for f in kept)


def test_threads_take_turns(table, make_candles):
    starts = [datetime(2024, 1, 1) + timedelta(days=2 * k) for k in range(4)]

    def work(start):
        for value in range(1, 4):
            table.upsert(make_candles(minute_rows(3, value, start)))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, starts))
    assert [r[3] for r in contents(table.candles())] == [3] * 12


def test_retention_beside_writes_loses_nothing(spark, tmp_path, make_candles):
    export = ExportTable(spark, str(tmp_path / "export"))
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 31)

    def rows(value, start):
        return to_export(make_candles(minute_rows(3, value, start)))

    export.upsert(rows(1, old).unionByName(rows(1, new)))
    with ThreadPoolExecutor(2) as pool:
        writes = [pool.submit(export.upsert, rows(v, new + timedelta(minutes=v - 2))) for v in (2, 3, 4)]
        runs = [pool.submit(export.delete_expired, NOW) for _ in range(2)]
        assert sum(r.result()["Min"] for r in runs) == 3
        for w in writes:
            w.result()
    assert [r["cp"] for r in export.read().orderBy("tms").collect()] == [2, 3, 4, 4, 4]


def test_time_bounds_prune_partitions(table, make_candles):
    table.upsert(make_candles(minute_rows(30, 1, step=24 * 60)), version=1)
    bounded = table.candles(units=["1m"], start=datetime(2024, 2, 6, 5), end=datetime(2024, 2, 15))
    assert [r[1].day for r in contents(bounded)] == list(range(7, 15))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("(p#" in line and "PushedFilters: [IsNotNull(timestamp)" in line for line in scans)
    several = table.candles(units=["1m", "1h"], start=datetime(2024, 2, 27))
    assert [r[1].day for r in contents(several)] == [27]


def test_year_patterns():
    for first in (1970, 1999, 2024, 2089):
        patterns = years_from(first)
        for year in range(1900, 2300):
            matches = sum(fnmatch(str(year), pattern) for pattern in patterns)
            assert matches == (1 if year >= first else 0)


def test_bound_past_the_data_reads_empty(table, make_candles):
    table.upsert(make_candles(minute_rows(3, 1)))
    assert table.candles(units=["1m"], start=datetime(2031, 1, 1)).count() == 0
    assert table.candles(units=["1d"], start=datetime(2020, 1, 1)).count() == 0
    assert table.candles(start=datetime(2020, 1, 1)).count() == 3


def test_created_at_is_the_first_write_of_a_minute(table, make_candles):
    table.upsert(make_candles(minute_rows(1, 1)))
    first = table.candles().first()["created_at"]
    assert first.year >= 2024
    table.upsert(make_candles(minute_rows(1, 2)))
    assert table.candles().first()["created_at"] == first
    table.upsert(make_candles(minute_rows(1, 3)))
    assert (table.candles().first()["created_at"], table.candles().first()["close"]) == (first, 3)
    jobs.rollup_all(table)
    assert {r["created_at"] for r in table.candles(units=DERIVED_UNITS).collect()} == {None}
    table.upsert(make_candles(minute_rows(1, 1), created_at="2024-01-29 00:01:00"))
    assert table.candles(units=["1m"]).first()["created_at"] == datetime(2024, 1, 29, 0, 1)


def test_reconciling_what_the_cascade_stored_finds_nothing(table, make_candles):
    rows = make_candles(minute_rows(90, 1), created_at="2024-01-29 00:00:30").where("minute(timestamp) < 1")
    table.upsert(rows)
    jobs.rollup_all(table)
    served = table.candles().drop("created_at")
    assert jobs.reconcile(table, served, 100).where("unit <> '1m'").count() == 0


def test_latest_per_symbol(table, make_candles):
    rows = minute_rows(5, 1) + [("1m", "2023-05-01 00:00:00", "OLD/KRW", 3, 3, 3, 3, 1)]
    table.upsert(make_candles(rows))
    table.upsert(make_candles(minute_rows(5, 2)))
    found = {r["symbol"]: (r["timestamp"], r["close"]) for r in table.latest("upbit", "1m").collect()}
    assert found == {
        "BTC/KRW": (datetime(2024, 1, 29, 0, 4), 2), "OLD/KRW": (datetime(2023, 5, 1), 3),
    }
    assert table.latest("bithumb", "1m").collect() == []


@pytest.mark.parametrize("weeks", [8, 60])
def test_the_newest_rows_do_not_need_the_history(table, make_candles, weeks):
    rows = [
        ("1m", (datetime(2024, 1, 29) - timedelta(weeks=w, minutes=m)).isoformat(), "BTC/KRW", w, w, w, w, 1)
        for w in range(weeks) for m in range(30)
    ]
    table.upsert(make_candles(rows))
    newest = table.newest(40, NOW)
    assert len(newest.inputFiles()) <= 5
    want = sorted((r[1] for r in rows), reverse=True)[:40]
    got = sorted((r["timestamp"].isoformat() for r in newest.collect()), reverse=True)
    assert got[:40] == want
    # A series that ended long ago is read back to its end, and only that unit.
    table.upsert(make_candles([("1m", "2021-01-01T00:00:00", "OLD/KRW", 1, 1, 1, 1, 1)]))
    assert "OLD/KRW" in {r["symbol"] for r in table.newest(1, NOW).collect()}


def test_short_series_are_read_whole(table, make_candles):
    rows = [("1h", f"{year}-{month:02}-01T00:00:00", "A/KRW", 1, 1, 1, 1, 1)
            for year in (2018, 2023) for month in range(1, 13)]
    table.upsert(make_candles(rows))
    for now in (NOW, NOW + timedelta(days=200), NOW + timedelta(days=400)):
        assert table.newest(1000, now).count() == len(rows)


def test_candles_before_the_epoch_are_found(table, make_candles):
    table.upsert(make_candles([(unit, "1931-01-05T00:00:00", "OLD/KRW", 1, 1, 1, 1, 1) for unit in ("1m", "1w")]))
    assert table.newest(10**9, NOW).count() == 2


@pytest.mark.parametrize("weeks", [8, 60])
def test_the_newest_exports_do_not_need_the_history(spark, make_candles, tmp_path, weeks):
    rows = [
        ("1m", (datetime(2024, 1, 29) - timedelta(weeks=w, minutes=m)).isoformat(), "BTC/KRW", w, w, w, w, 1)
        for w in range(weeks) for m in range(30)
    ]
    export = ExportTable(spark, str(tmp_path / "export"))
    assert export.newest_closed("UPBIT", ["Min"], 3, NOW).count() == 0
    export.upsert(to_export(make_candles(rows)))
    newest = export.newest_closed("UPBIT", ["Min", "Day"], 40, NOW)
    assert len(newest.inputFiles()) <= 5
    whole = sorted((r["tms"] for r in export.read().collect()), reverse=True)
    assert sorted((r["tms"] for r in newest.collect()), reverse=True) == whole[1:41]
    # Of another market nothing, of a clock behind the data the same rows.
    assert export.newest_closed("BITHUMB", ["Min"], 40, NOW).count() == 0
    early = export.newest_closed("UPBIT", ["Min"], 40, NOW - timedelta(weeks=3))
    assert sorted((r["tms"] for r in early.collect()), reverse=True) == whole[1:41]


def test_incremental_cascade_equals_full(table, make_candles):
    rng = random.Random(5)
    rows = [
        ("1m", (datetime(2024, 1, 10) + timedelta(minutes=m)).isoformat(), s, m % 7, 9, 0, m % 5, 1)
        for m in sorted({*rng.sample(range(31_680), 800), 31_683, 31_685, 31_687})
        for s in ("A/KRW", "B/KRW")
    ]
    early = [row for row in rows if row[1] < "2024-02-01T00:03"]
    assert 0 < len(early) < len(rows)
    table.upsert(make_candles(early), version=1)
    jobs.rollup_all(table)
    table.upsert(make_candles(rows[len(early):]))
    jobs.rollup_latest(table, NOW)
    columns = ["unit", "timestamp", "symbol", "open", "high", "low", "close", "volume"]
    stored = sorted(map(tuple, table.candles(units=DERIVED_UNITS).select(*columns).collect()))
    direct = rollup_all(table.candles(units=["1m"])).select(*columns)
    assert stored == sorted(map(tuple, direct.collect()))


def test_rollup_history_derives_what_is_not_served(table, make_candles):
    table.upsert(make_candles([
        ("5m", f"2024-01-29 00:{m:02}:00", "A/KRW", m, m + 1, m - 1, m, 1) for m in range(0, 60, 5)
    ], exchange="bithumb"))
    table.upsert(make_candles([("1h", "2024-01-29", "A/KRW", 1, 5, 1, 5, 7)], exchange="bithumb"))
    jobs.rollup_history(table, "bithumb", frozenset({"1m", "3m", "5m", "10m", "30m", "1h"}))
    counts = {r["unit"]: r["n"] for r in table.candles().groupBy("unit").agg(F.count("*").alias("n")).collect()}
    assert counts == {"5m": 12, "15m": 4, "1h": 1, "4h": 1, "1d": 1, "1w": 1}


def test_export_refresh_and_retention(spark, table, make_candles, tmp_path):
    rows = [
        (unit, (lookback_start(NOW, unit) - timedelta(milliseconds=spec.ms * n)).isoformat(),
         "BTC/KRW", 1, 1, 1, 1, 1)
        for unit, spec in UNITS.items() for n in (*range(-1, 4), 1996, 1997, 1998, 2005, 3999, 4005)
    ]
    table.upsert(make_candles(rows))
    export = ExportTable(spark, str(tmp_path / "export"))
    export.create()
    jobs.export_history(table, export, limit=1)
    assert export.read().count() == len(UNITS)
    jobs.export_latest(table, export, NOW)
    per_unit = export.read().groupBy("unit").count().collect()
    assert {r["count"] for r in per_unit} == {2}
    jobs.export_history(table, export)
    everything = to_export(table.candles()).select("unit", "tms").collect()
    assert export.read().count() == len(everything)
    cutoffs = retention_cutoffs(NOW)
    kept = sorted((r["unit"], r["tms"]) for r in everything if r["tms"] >= cutoffs.get(r["unit"], r["tms"]))
    deleted = jobs.apply_retention(export, NOW)
    assert sum(deleted.values()) == len(everything) - len(kept) > 0
    assert "Week" not in deleted
    assert sorted((r["unit"], r["tms"]) for r in export.read().collect()) == kept
    assert sum(jobs.apply_retention(export, NOW).values()) == 0


def test_trade_sink(spark, make_trades, tmp_path):
    trades = make_trades([("2024-01-15 00:00:00", "BTC/KRW", 1, 1, 1), ("2024-01-16 00:00:00", "BTC/KRW", 1, 1, 2)])
    append_trades(trades, str(tmp_path / "trades"))
    stored = spark.read.parquet(str(tmp_path / "trades"))
    assert stored.where("created_at IS NOT NULL").select("day").distinct().count() == 2
