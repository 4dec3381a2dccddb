from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.functions import bucket_ms, bucket_start, is_aligned, period_start
from candlewick.functions.times import period_of
from candlewick.units import UNITS, cascade_levels, floor_time, lookback_start

MONDAY = datetime(1970, 1, 5)


def instants_around_edges():
    """Starts of buckets of every unit in a leap-year spring, moments beside them, and others."""
    base, found = datetime(2032, 2, 26, 21, 7, 13, 500_000), set()
    for spec in UNITS.values():
        step = timedelta(milliseconds=spec.ms)
        edge = MONDAY + (base - MONDAY) // step * step
        for n in range(3):
            for beside in (-1, 0, 59_999, 60_000):
                found.add(edge + n * step + timedelta(milliseconds=beside))
    return sorted(found | {base + timedelta(minutes=37 * n) for n in range(40)})


def starts(moment, unit):
    """Counts minutes from a Monday, one by one rule for all units."""
    minutes = (moment - MONDAY) // timedelta(minutes=1)
    return minutes % (UNITS[unit].ms // 60_000) == 0


@pytest.fixture(scope="module")
def instants(spark):
    rows = [(moment,) for moment in instants_around_edges()]
    return spark.createDataFrame(rows, "ts timestamp_ntz")


def test_alignment(instants):
    flagged = instants.select("ts", *[is_aligned("ts", u).alias(u) for u in UNITS]).collect()
    for row in flagged:
        assert [u for u in UNITS if row[u]] == [u for u in UNITS if starts(row["ts"], u)]
    assert all(any(row[u] for row in flagged) for u in UNITS)


def test_alignment_by_unit_column(instants):
    units = F.explode(F.array(*map(F.lit, UNITS))).alias("unit")
    rows = instants.select("ts", units).where(is_aligned("ts")).collect()
    assert len(rows) == sum(starts(m, u) for m in instants_around_edges() for u in UNITS)


@pytest.mark.parametrize("beside, start", [(-1, -60_000), (0, 0), (1, 0), (59_999, 0)])
def test_minute_bucket(spark, beside, start):
    edge = 1_961_000_040_000
    assert edge % 60_000 == 0
    row = spark.range(1).select(
        F.timestamp_millis(F.lit(edge + beside)).cast("timestamp_ntz").alias("ts"))
    assert row.select(bucket_ms("ts", "1m").alias("b")).first()["b"] == edge + start


@pytest.mark.parametrize("zone", ["UTC", "KST"])
@pytest.mark.parametrize("unit", list(UNITS))
def test_buckets_agree_with_driver_side(instants, unit, zone):
    rows = instants.select("ts", bucket_start("ts", unit, zone).alias("b")).collect()
    for row in rows:
        assert row["b"] == floor_time(row["ts"], unit, zone)
        assert 0 <= (row["ts"] - row["b"]).total_seconds() * 1000 < UNITS[unit].ms


def test_calendar_starts():
    moment = datetime(2032, 3, 3, 16, 30)  # a Wednesday
    assert floor_time(moment, "1w") == datetime(2032, 3, 1)
    assert floor_time(moment, "1d", "KST") == datetime(2032, 3, 3, 15)
    assert floor_time(moment, "1w", "KST") == datetime(2032, 2, 29, 15)
    assert floor_time(moment, "4h", "KST") == datetime(2032, 3, 3, 15)
    assert lookback_start(moment, "1h") == datetime(2032, 3, 3, 15)
    with pytest.raises(ValueError):
        floor_time(moment, "1d", "CET")


def test_session_zone_does_not_move_buckets(spark, instants):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = instants.select("ts", bucket_start("ts", "1d").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(row["b"] == floor_time(row["ts"], "1d") for row in rows)


@pytest.mark.parametrize("unit", ["1m", "15m", "1d"])
def test_periods(instants, unit):
    for row in instants.select("ts", period_start("ts", unit).alias("p")).collect():
        assert row["p"] == period_of(row["ts"], unit)
    assert period_of(datetime(2032, 3, 7), "1m") == date(2032, 3, 1)


def test_cascade_levels():
    assert cascade_levels() == [
        ("1m", ["3m", "5m", "10m", "15m"]), ("15m", ["30m", "1h"]), ("1h", ["4h", "1d"]),
        ("1d", ["1w"]),
    ]
    assert ("5m", ["15m"]) in cascade_levels({"15m": "5m"})
    with pytest.raises(ValueError):
        cascade_levels({"15m": "2m"})
