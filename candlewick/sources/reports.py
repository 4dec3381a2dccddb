"""Report sinks (K8, K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_diff_report(diffs: DataFrame, path: str) -> None:
    """Difference rows as JSON, one folder per (exchange, unit, symbol)."""
    named = diffs.withColumn("symbol", F.regexp_replace("symbol", "^([^/]*)/", "$1_"))
    folders = ["exchange", "unit", "symbol"]
    named.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).json(path)


def write_summary_report(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").partitionBy("exchange").json(path)


def write_csv_summary(summary: DataFrame, path: str) -> None:
    """One summary row per (code, unit), with a header line."""
    # Column names of the CSV report.
    names = ["code", "candle", "diffCount", "diffPercent", "priceDiffCount", "volumeDiffCount",
             "maxVolumeDiff", "maxVolumeDiffDate"]
    rows = summary.withColumns({
        "diff_percent": F.format_string("%.2f", "diff_percent"),
        "max_volume_diff": F.format_string("%.2f", "max_volume_diff"),
        "max_volume_diff_date": F.date_format("max_volume_diff_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    })
    rows.toDF(*names).write.mode("overwrite").option("header", True).csv(path)
