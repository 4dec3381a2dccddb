import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from candlewick.operators.fold import (
    ARRIVAL, SEQUENCE, as_states, fold_trades, merge_states, seed_states,
)
from candlewick.functions import epoch_ms, exact_sum


def brute_force(rows, unit_s=60, dedup=True):
    """One trade at a time, in the order given, as a collector would see them."""
    candles, seen = {}, set()
    for at, symbol, price, amount, id_ in sorted(rows, key=lambda r: (r[0], r[4])):
        moment = datetime.fromisoformat(at)
        start = moment - timedelta(
            seconds=(moment - datetime(1970, 1, 1)).total_seconds() % unit_s)
        if dedup and (symbol, start, id_) in seen:
            continue
        seen.add((symbol, start, id_))
        if (symbol, start) not in candles:
            candles[symbol, start] = [price, price, price, price, 0]
        candle = candles[symbol, start]
        candle[1], candle[2], candle[3] = max(candle[1], price), min(candle[2], price), price
        candle[4] += round(amount * 1e8)
    return {key: (*c[:4], c[4] / 1e8) for key, c in candles.items()}


def as_dict(candles):
    return {
        (r["symbol"], r["timestamp"]): tuple(r[c] for c in ("open", "high", "low", "close", "volume"))
        for r in candles.collect()
    }


def random_rows(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for id_ in range(n):
        ms = rng.randrange(0, 600_000, 500)  # coarse, so timestamps tie often
        at = (datetime(2024, 1, 15) + timedelta(milliseconds=ms)).isoformat()
        rows.append((at, rng.choice(["BTC/KRW", "BTC/KRW", "ETH/KRW"]), rng.randint(1, 50) / 4,
                     rng.randint(1, 10**9) / 1e8, id_))
    return rows + rng.sample(rows, n // 8)


TIE = [
    ("2031-07-09 21:14:06.125", "TEA/KRW", 318.0, 7.25, 902),
    ("2031-07-09 21:14:06.125", "TEA/KRW", 305.5, 0.00000003, 901),
    ("2031-07-09 21:14:06.125", "TEA/KRW", 311.0, 40.5, 903),
]


@pytest.mark.parametrize("rows", [TIE, TIE[::-1], TIE[1:] + TIE[:1]])
def test_equal_timestamps_follow_ids(make_trades, rows):
    candle = fold_trades(make_trades(rows)).first()
    assert candle["timestamp"] == datetime(2031, 7, 9, 21, 14)
    assert (candle["open"], candle["high"], candle["low"], candle["close"]) == (305.5, 318, 305.5, 311)
    assert candle["volume"] == 47.75000003


def test_one_busy_minute(make_trades):
    """Ninety trades of one minute, with ties out of the order of their ids."""
    rng = random.Random(2031)
    rows = []
    for n in range(90):
        at = datetime(2031, 7, 9, 21, 14) + timedelta(milliseconds=rng.randrange(0, 60_000, 750))
        rows.append((at.isoformat(), "TEA/KRW", 300 + rng.randint(-40, 40) / 8,
                     rng.randint(1, 10**8) / 1e8, 1000 + n))
    rows.sort(key=lambda r: r[0])
    first, last = min(rows, key=lambda r: (r[0], r[4])), max(rows, key=lambda r: (r[0], r[4]))
    candle = fold_trades(make_trades(rows), details=True).first()
    assert (candle["open"], candle["close"]) == (first[2], last[2])
    assert (candle["high"], candle["low"]) == (max(r[2] for r in rows), min(r[2] for r in rows))
    assert candle["volume"] == sum(round(r[3] * 1e8) for r in rows) / 1e8
    assert candle["first_trade"] == datetime.fromisoformat(first[0])
    assert (candle["last_trade"], candle["last_tie"]) == (datetime.fromisoformat(last[0]), last[4])


def test_tiny_and_huge_amounts(make_trades):
    rows = [("2031-07-09 21:14:06", "DUST/KRW", 1, 4e-9, n) for n in range(1000)]
    rows += [("2031-07-09 21:14:06", "SHIB/KRW", 1, 1e15, n) for n in range(30)]
    got = {k[0]: v[4] for k, v in as_dict(fold_trades(make_trades(rows))).items()}
    assert got == {"DUST/KRW": 4e-6, "SHIB/KRW": 3e16}


def test_candles_of_many_largest_amounts(make_trades):
    rows = [("2031-07-09 21:14:06", "SHIB/KRW", 1, 8e18, n) for n in range(300)]
    rows += [("2031-07-09 21:14:06", "DEBT/KRW", 1, -9e18, n) for n in range(300)]
    got = {k[0]: v[4] for k, v in as_dict(fold_trades(make_trades(rows), "1d")).items()}
    assert got == {"SHIB/KRW": 2.4e21, "DEBT/KRW": -2.7e21}


@pytest.mark.parametrize("sign", [1, -1])
@pytest.mark.parametrize("left", [0.0, 1e-12, 0.25, -1e-12, -0.25])
def test_small_amounts_round_the_largest_sums(spark, sign, left):
    """The whole units lie in the middle of two doubles, so what is left over decides."""
    values = [2.0**62] * 256 + [2.0**17, left]
    rows = spark.createDataFrame([(sign * v,) for v in values], "v double")
    exact = sum(Fraction(v) for v in values)
    assert rows.agg(exact_sum("v").alias("s")).first()["s"] == sign * float(exact)


def test_trades_without_id_all_count(make_trades):
    rows = [("2031-07-09 21:14:06", "TEA/KRW", p, 1, None) for p in (2, 3, 3)]
    rows += [("2031-07-09 21:14:07", "TEA/KRW", 4, 1, 7)] * 2
    trades = make_trades(rows)
    assert as_dict(fold_trades(trades)) == as_dict(fold_trades(trades.repartition(3)))
    candle = fold_trades(trades).first()
    assert (candle["volume"], candle["close"], candle["low"]) == (4, 4, 2)


def test_arrival_needs_an_order(make_trades):
    trades = make_trades([("2031-07-09 21:14:06", "TEA/KRW", 2, 1, 1)])
    blind = trades.withColumn("arrival_seq", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="order of arrival"):
        fold_trades(blind, profile=ARRIVAL).collect()


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_brute_force_in_any_order(make_trades, seed):
    rows = random_rows(seed)
    expected = brute_force(rows)
    random.Random(seed).shuffle(rows)
    trades = make_trades(rows).repartition(4)
    assert as_dict(fold_trades(trades)) == expected
    assert as_dict(fold_trades(trades, "5m")) == brute_force(rows, 300)


def test_arrival_profile_keeps_repeats(make_trades):
    rows = [(at, s, p, a, i) for i, (at, s, p, a, _) in enumerate(sorted(random_rows(7)))]
    assert as_dict(fold_trades(make_trades(rows), profile=ARRIVAL)) == brute_force(rows, dedup=False)


def test_details(make_trades):
    rows = [
        ("2031-07-09 21:14:02.250", "TEA/KRW", 10, 1, 5), ("2031-07-09 21:14:41.500", "TEA/KRW", 12, 1, 9),
        ("2031-07-09 21:14:41.500", "TEA/KRW", 11, 1, 8),
    ]
    candle = fold_trades(make_trades(rows), details=True).first()
    assert candle["first_trade"] == datetime(2031, 7, 9, 21, 14, 2, 250000)
    assert candle["last_trade"] == datetime(2031, 7, 9, 21, 14, 41, 500000)
    assert (candle["last_tie"], candle["close"]) == (9, 12)


def test_malformed_numbers_do_not_move_candles(make_trades):
    rows = [("2031-07-09 21:14:04", "BTC/KRW", 10, 1, 1), ("2031-07-09 21:14:05", "BTC/KRW", float("nan"), 1, 2)]
    trades = make_trades(rows)
    bad = trades.limit(1).withColumns({"price": F.lit(None).cast("double"), "id": F.lit(3).cast("long")})
    candle = fold_trades(trades.unionByName(bad)).first()
    assert (candle["close"], candle["volume"]) == (10, 1)


@pytest.mark.parametrize("seed", range(2))
def test_stored_partial_plus_rest_equals_whole(make_trades, seed):
    trades = make_trades(random_rows(seed)).dropDuplicates(["id"])
    early = F.pmod(epoch_ms("timestamp"), F.lit(60_000)) < 20_000
    seeds = seed_states(fold_trades(trades.where(early)))
    merged = merge_states(seeds.unionByName(as_states(trades.where(~early), SEQUENCE)))
    assert as_dict(merged) == as_dict(fold_trades(trades))


def test_one_hot_minute(spark, make_trades):
    """All rows in one candle and all ids repeated: nothing is lost or counted twice."""
    base = make_trades([("2024-01-15 00:00:00", "BTC/KRW", 1, 1, 0)]).drop("id", "price")
    hot = spark.range(20_000).select("id", F.col("id").cast("double").alias("price"), *[
        F.lit(v).cast(base.schema[c].dataType).alias(c) for c, v in base.first().asDict().items()
    ])
    candle = fold_trades(hot.unionByName(hot)).collect()
    assert len(candle) == 1
    assert (candle[0]["open"], candle[0]["close"], candle[0]["volume"]) == (0, 19_999, 20_000)
