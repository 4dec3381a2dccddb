import random
from datetime import datetime, timedelta

import pytest

from candlewick.operators import series


@pytest.fixture
def candles(make_candles):
    rng = random.Random(3)
    rows = []
    for unit, step in (("1m", 1), ("3m", 3), ("1h", 60)):
        for symbol in ("A/KRW", "B/KRW"):
            for i in rng.sample(range(400), 300):
                # Far apart stretches put gaps across chunk borders.
                at = datetime(2024, 1, 1) + timedelta(minutes=step * (i + 30_000 * (i // 100)))
                rows.append((unit, at.isoformat(), symbol, 1, 1, 1, 1, i))
    return make_candles(rows).cache()


def by_series(candles):
    groups = {}
    for row in candles.collect():
        groups.setdefault((row["exchange"], row["unit"], row["symbol"]), []).append(row["timestamp"])
    return {key: sorted(times) for key, times in groups.items()}


def test_gaps_equal_brute_force(candles):
    length = {"1m": 60, "3m": 180, "1h": 3600}
    expected = {
        (*key, before, after)
        for key, times in by_series(candles).items()
        for before, after in zip(times, times[1:])
        if (after - before).total_seconds() != length[key[1]]
    }
    found = series.gaps(candles).collect()
    assert {(r["exchange"], r["unit"], r["symbol"], r["previous"], r["timestamp"]) for r in found} == expected
    assert len(found) == len(expected)


def test_newest_n(candles):
    expected = {key: times[-20:-5] for key, times in by_series(candles).items()}
    assert by_series(series.newest_n(candles, 20, skip=5)) == expected


def test_newest_by_depth(candles):
    depths = {"upbit": {"1m": 7, "1h": 2}}
    expected = {
        key: times[-depths["upbit"][key[1]]:]
        for key, times in by_series(candles).items() if key[1] in depths["upbit"]
    }
    assert by_series(series.newest_by_depth(candles, depths)) == expected


def test_latest_and_closed(candles):
    expected = {key: times[-1:] for key, times in by_series(candles).items()}
    assert by_series(series.latest_per_series(candles)) == expected
    open_ones = series.with_closed(candles).where("NOT closed")
    assert by_series(open_ones) == expected
    rest = {key: times[:-1] for key, times in by_series(candles).items()}
    assert by_series(series.drop_unclosed(candles)) == rest
    assert by_series(series.drop_newest(candles)) == rest


def test_serving_queries(candles):
    assert [r["symbol"] for r in series.symbols(candles).collect()] == ["A/KRW", "B/KRW"]
    assert series.oldest_timestamp(candles).first()["timestamp"] == min(
        times[0] for times in by_series(candles).values())
    times = by_series(candles)["upbit", "1m", "A/KRW"]
    page = series.candles_by_symbol(candles, "upbit", "1m", "A/KRW", since=3, limit=10)
    assert [r["timestamp"] for r in page.collect()] == times[::-1][3:10]
    assert "created_at" in page.columns
    up = series.candles_by_symbol(candles, "upbit", "1h", "A/KRW", limit=5, ascending=True)
    assert "created_at" not in up.columns
    assert [r["timestamp"] for r in up.collect()] == by_series(candles)["upbit", "1h", "A/KRW"][:5]
