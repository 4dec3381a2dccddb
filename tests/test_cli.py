import json

import pytest

from candlewick.__main__ import main
from candlewick.sources.tables import CandleTable, ExportTable


def test_jobs_from_the_command_line(spark, make_candles, tmp_path, capsys):
    candles, export, report = (str(tmp_path / name) for name in ("candles", "export", "gaps"))
    main(["create", "--candles", candles, "--export", export])
    table = CandleTable(spark, candles)
    table.upsert(make_candles([
        ("1m", f"2024-01-29 00:0{m}:00", "A/KRW", 1, 1, 1, 1, 1) for m in (0, 1, 4)
    ]))
    now = ["--now", "2024-01-29T00:05:00"]
    main(["rollup-latest", "--candles", candles, *now])
    assert table.candles(units=["5m"]).first()["volume"] == 3
    main(["export-latest", "--candles", candles, "--export", export, *now])
    main(["export-history", "--candles", candles, "--export", export])
    assert ExportTable(spark, export).read().count() == table.candles().count()
    main(["find-gaps", "--candles", candles, "--report", report])
    gap = spark.read.json(report).where("unit = '1m'").first()
    assert (gap["symbol"], gap["step_ms"]) == ("A/KRW", 180_000)
    main(["retention", "--export", export, "--now", "2024-02-05T00:00:00"])
    assert "'Min': 3" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["retention"])


def test_landed_files_from_the_command_line(spark, tmp_path):
    candles, export, progress = (str(tmp_path / name) for name in ("candles", "export", "progress"))

    def land(name, rows):
        path = tmp_path / name
        path.write_text("\n".join(json.dumps(row) for row in rows))
        return str(path)

    main(["create", "--candles", candles, "--export", export])
    (tmp_path / "trades.json").write_text(json.dumps([
        {"symbol": "TEA/KRW", "side": "buy", "price": 5.0 + n, "amount": 1.0, "sequential_id": str(n),
         "timestamp": f"2031-07-09 21:0{n}:00.5"} for n in range(4)]))
    main(["load-trades", "--candles", candles, "--exchange", "upbit", "--source", str(tmp_path / "trades.json")])
    start = 1_941_483_600_000
    arrays = land("history.json", [
        {"exchange": "bithumb", "unit": unit, "symbol": "TEA/KRW", "ohlcv": [start + n * ms, 1, 3, 1, 2, 4]}
        for unit, ms in (("5m", 300_000), ("1h", 3_600_000)) for n in range(3)])
    main(["load-history", "--candles", candles, "--source", arrays, "--native-grid"])
    main(["rollup-history", "--candles", candles, "--exchange", "bithumb", "--native", "5m,1h"])
    table = CandleTable(spark, candles)
    assert table.candles(exchange="bithumb", units=["15m"]).first()["volume"] == 12

    (tmp_path / "messages").mkdir()
    record = {"symbol": "TEA_KRW", "buySellGb": "1", "contPrice": "7", "contQty": "2", "contAmt": "14",
              "contDtm": "2031-07-10 06:10:01.000001"}
    message = {"type": "transaction", "content": {"list": [record, {**record, "contPrice": "8"}]}}
    land("messages/a.json", [{"seq": 1, "value": json.dumps(message)}])
    main(["stream", "--candles", candles, "--exchange", "bithumb", "--source", str(tmp_path / "messages"),
          "--checkpoint", progress, "--once"])
    minute = table.candles(exchange="bithumb", units=["1m"]).first()
    assert (minute["open"], minute["close"], minute["volume"]) == (7, 8, 4)

    main(["export-history", "--candles", candles, "--export", export])
    served = {"market": "KRW-TEA", "page": 1, "opening_price": 6, "high_price": 6, "low_price": 6,
              "trade_price": 6, "candle_acc_trade_volume": 1.0}
    at = [{**served, "unit": "1m", "candle_date_time_utc": f"2031-07-09T21:0{n}:00"} for n in range(4)]
    report = str(tmp_path / "report")
    main(["reconcile", "--candles", candles, "--exchange", "upbit", "--report", report,
          "--source", land("rest.json", at), "--depth", '{"upbit": {"1m": 4}}'])
    assert spark.read.json(f"{report}/summary").first()["diff_count"] == 2
    marks = str(tmp_path / "marks")
    main(["reconcile-export", "--export", export, "--exchange", "upbit", "--report", marks,
          "--source", land("rest_export.json", [{**row, "unit": "Min"} for row in at])])
    assert spark.read.option("header", True).csv(marks).first()["priceDiffCount"] == "2"
