import csv
import json
import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest

from candlewick.functions import to_fixed
from candlewick.functions.numbers import exact_sum
from candlewick.operators import compare
from candlewick.operators.export import to_export
from candlewick.plans import jobs
from candlewick.sources.tables import CandleTable, ExportTable
from pyspark.sql import functions as F


@pytest.mark.parametrize("places", [2, 4])
def test_to_fixed_rounds_the_exact_value(spark, places):
    rng = random.Random(places)
    values = [k / 32 for k in range(100)] + [k / 8 for k in range(50)] + [1.005, 1.00045, 0.00005]
    values += [rng.random() * 10 ** rng.randint(-5, 6) for _ in range(500)]
    values += [round(rng.random(), places) + 5 / 10 ** (places + 1) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    step = Decimal(1).scaleb(-places)
    for row in rows.select("v", to_fixed(F.col("v"), places).alias("r")).collect():
        assert row["r"] == float(Decimal(row["v"]).quantize(step, ROUND_HALF_UP)), row["v"]


def test_exact_sum_ignores_order(spark):
    rng = random.Random(2)
    units = [rng.randrange(10 ** rng.randint(1, 15)) for _ in range(2000)]
    rows = spark.createDataFrame([(u / 1e8,) for u in units], "v double")
    for partitions in (1, 7):
        total = rows.repartition(partitions).agg(exact_sum("v").alias("s")).first()["s"]
        assert total == float(Decimal(sum(units)).scaleb(-8))


def hours(*rows):
    return [("1h", f"2024-01-15 {h:02}:00:00", s, *values) for h, s, *values in rows]


@pytest.fixture
def sides(make_candles):
    stored = make_candles(hours(
        (0, "A/KRW", 1, 2, 1, 2, 5), (1, "A/KRW", 1, 2, 1, 2, 5), (3, "A/KRW", 1, 2, 1, 2, 5.09),
        (4, "A/KRW", 1, 2, 1, 2, 5), (0, "ONLY/KRW", 1, 1, 1, 1, 1),
    ), created_at="2024-01-15 00:01:30")
    served = make_candles(hours(
        (0, "A/KRW", 1, 2, 1, 2, 5), (1, "A/KRW", 1, 3, 1, 2, 5.25), (2, "A/KRW", 1, 2, 1, 2, 5),
        (3, "A/KRW", 1, 2, 1, 2, 5), (4, "A/KRW", 9, 9, 9, 9, 9),
        (0, "NEW/KRW", 1, 1, 1, 1, 1), (1, "NEW/KRW", 1, 1, 1, 1, 1),
    ) + [("1h", "2024-01-15 03:20:00", "A/KRW", 0, 0, 0, 0, 0)])
    return stored, served


@pytest.fixture(params=[False, True])
def closed_sides(sides, request):
    stored, served = sides
    return stored, compare.closed_on_grid(served, ranked=request.param)


def test_diffs(closed_sides):
    found = {(r["symbol"], r["date"].hour): r for r in compare.reconcile_diffs(*closed_sides).collect()}
    # The newest served candle is still open and the misaligned one is no candle.
    assert set(found) == {("A/KRW", 1), ("A/KRW", 2), ("NEW/KRW", 0)}
    changed, gap = found["A/KRW", 1], found["A/KRW", 2]
    assert (changed["open"], changed["high"], changed["volume"]) == (False, True, True)
    assert changed["volume_delta"] == 0.25
    assert gap["db_candle"] is None and gap["exchange_candle"]["close"] == 2


def test_summary(closed_sides):
    rows = {r["symbol"]: r for r in compare.reconcile_summary(*closed_sides).collect()}
    a = rows["A/KRW"]
    assert (a["db_count"], a["exchange_count"], a["diff_count"], a["gap_count"]) == (4, 4, 2, 1)
    assert (a["high_diff_count"], a["volume_diff_count"], a["open_diff_count"]) == (1, 1, 0)
    assert a["max_volume_diff"] == 0.25
    assert a["created_at_diff_count"] == 4
    # Nothing stored: every served candle is a gap. Nothing served: late candles still count.
    assert (rows["NEW/KRW"]["gap_count"], rows["NEW/KRW"]["max_volume_diff"]) == (1, None)
    assert (rows["ONLY/KRW"]["diff_count"], rows["ONLY/KRW"]["created_at_diff_count"]) == (0, 1)


def test_created_lag(make_candles):
    rows = [("1m", "2024-01-15 00:00:00", "A/KRW", 1, 1, 1, 1, 1)]
    for created, late in (
        ("2024-01-15 00:01:01", False), ("2024-01-15 00:01:01.001", True),
        ("2024-01-14 23:58:00", True), ("1970-01-01 00:00:00", False), (None, False),
    ):
        flagged = compare.with_created_lag(make_candles(rows, created_at=created)).first()
        assert flagged["created_diff"] is late


def test_reconcile_job_reports(spark, sides, tmp_path):
    stored, served = sides
    table = CandleTable(spark, str(tmp_path / "candles"))
    table.upsert(stored)
    summary = jobs.reconcile(table, served, {"upbit": {"1h": 3}}, str(tmp_path / "report"))
    # Newest three per side: hours 1, 3, 4 stored; 3 (twice, one misaligned) and 4 served.
    rows = summary.collect()
    assert {r["symbol"] for r in rows} == {"A/KRW", "NEW/KRW", "ONLY/KRW"}
    assert {r["check_count"] for r in rows} == {3}
    path = tmp_path / "report" / "diffs" / "exchange=upbit" / "unit=1h" / "symbol=NEW_KRW"
    (line,) = [text for f in path.glob("*.json") for text in f.read_text().splitlines()]
    assert json.loads(line)["exchange_candle"]["close"] == 1
    assert list((tmp_path / "report" / "summary" / "exchange=upbit").glob("*.json"))


def test_export_summary(spark, make_candles, tmp_path):
    rows = [("15m", f"2024-01-15 0{h}:00:00", "A/KRW", 1, 2, 1, 2, 1.0) for h in range(6)]
    rows += [("15m", f"2024-01-15 0{h}:00:00", "B/KRW", 1, 2, 1, 2, 1.0) for h in range(2)]
    export = ExportTable(spark, str(tmp_path / "export"))
    export.upsert(to_export(make_candles(rows)))
    theirs = [list(row) for row in rows]
    theirs[0][4] = 3                       # high
    theirs[1][7] = theirs[3][7] = 1.5      # volume, the same difference twice
    theirs[2][7] = 1.00004                 # equal to four places
    theirs[5][6] = 9                       # newest: still open, not compared
    del theirs[4]                          # not served: skipped
    rest = to_export(make_candles([tuple(r) for r in theirs]))
    summary = jobs.reconcile_export(export, rest, report_path=str(tmp_path / "csv"))
    a, b = summary.orderBy("code").collect()
    assert (a["code"], a["candle"], a["diff_count"], a["diff_percent"]) == ("KRW-A", "min15", 3, 0.3)
    assert (a["price_diff_count"], a["volume_diff_count"], a["max_volume_diff"]) == (1, 2, 0.5)
    assert a["max_volume_diff_date"] == datetime(2024, 1, 15, 3)
    assert (b["diff_count"], b["max_volume_diff_date"]) == (0, None)
    lines = [r for f in (tmp_path / "csv").glob("*.csv") for r in csv.DictReader(f.open())]
    assert {r["code"]: r["diffPercent"] for r in lines} == {"KRW-A": "0.30", "KRW-B": "0.00"}
    assert "2024-01-15T03:00:00.000Z" in {r["maxVolumeDiffDate"] for r in lines}


def test_export_diff_rows(make_candles):
    rows = [("1d", "2024-01-15", "A/KRW", 1, 2, 1, 2, 1.0)]
    theirs = [("1d", "2024-01-15", "A/KRW", 1, 2, 0, 2, 2.0)]
    flagged = compare.export_flags(to_export(make_candles(rows)), to_export(make_candles(theirs)))
    (row,) = compare.export_diff_rows(flagged).collect()
    assert (row["open"], row["low"], row["volume"], row["volume_diff"]) == ("x", "o", "o", 1)
