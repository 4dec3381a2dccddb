from datetime import datetime, timedelta

import pytest

from candlewick.operators.fold import fold_trades
from candlewick.operators.rollup import (
    rollup, rollup_all, rollup_cascade, rollup_latest, rollup_many, rollup_nested, rollup_range,
)
from candlewick.units import DERIVED_UNITS, lookback_start
from test_fold import random_rows


@pytest.fixture
def minutes(make_trades):
    """Two weeks of scattered trades over a year's end, so every unit has several buckets."""
    rows = []
    for day in range(14):
        for i, (at, symbol, price, amount, id_) in enumerate(random_rows(day, 30)):
            moment = datetime.fromisoformat(at) - timedelta(days=20 - day, hours=i % 24)
            rows.append((moment.isoformat(), symbol, price, amount, day * 1000 + id_))
    return fold_trades(make_trades(rows)).cache()


def rows_of(candles):
    return sorted(tuple(row) for row in candles.collect())


@pytest.mark.parametrize("timezone", ["UTC", "KST"])
def test_cascade_equals_direct(minutes, timezone):
    direct = rows_of(rollup_all(minutes, timezone))
    assert rows_of(rollup_cascade(minutes, timezone)) == direct
    assert rows_of(rollup_nested(minutes, timezone)) == direct
    single = [row for unit in DERIVED_UNITS for row in rows_of(rollup(minutes, unit, timezone))]
    assert sorted(single) == direct


def test_rollup_keeps_bounds(minutes):
    for row in rollup_all(minutes).collect():
        assert row["low"] <= min(row["open"], row["close"])
        assert max(row["open"], row["close"]) <= row["high"]


def test_latest_buckets_are_whole(minutes):
    now = datetime(2024, 1, 8, 11, 50)
    for unit in DERIVED_UNITS:
        whole = [r for r in rollup(minutes, unit).collect() if r["timestamp"] >= lookback_start(now, unit)]
        assert rows_of(rollup_latest(minutes, unit, now)) == sorted(map(tuple, whole))
    starts = {unit: lookback_start(now, unit) for unit in DERIVED_UNITS}
    each = [row for u in DERIVED_UNITS for row in rows_of(rollup_latest(minutes, u, now))]
    assert rows_of(rollup_many(minutes, DERIVED_UNITS, starts=starts)) == sorted(each)


def test_range_equals_week_bucket(minutes):
    start = datetime(2024, 1, 1)
    week = [r for r in rows_of(rollup(minutes, "1w")) if r[2] == start]
    assert rows_of(rollup_range(minutes, "1w", start, start + timedelta(days=7))) == week


def test_native_units_are_not_derived(minutes):
    native = frozenset({"3m", "5m", "10m", "30m", "1h"})
    served = minutes.unionByName(rollup_many(minutes, sorted(native)))
    derived = rollup_cascade(served, bases={"15m": "5m"}, native=native)
    assert rows_of(derived) == rows_of(rollup_many(minutes, ["15m", "4h", "1d", "1w"]))


def test_nested_rollup_shuffles_once(spark, minutes, tmp_path):
    minutes.write.parquet(str(tmp_path / "minutes"))
    stored = spark.read.parquet(str(tmp_path / "minutes"))
    plan = rollup_nested(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rollup_nested(stored.limit(0)).count() == 0
