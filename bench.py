"""Headline queries, each written to a sink that discards rows; prints one JSON line.

A first untimed run of each query warms code generation, the second is timed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from candlewick.plans import jobs
from candlewick.plans.catalog import NOW, QUERIES, minutes
from candlewick.session import SESSION_CONF, shared_folder
from candlewick.sources.tables import CandleTable

HEADLINE = [
    "candles_1m", "candles_arrival_1m", "candles_1d", "rollup_15m", "rollup_1d", "rollup_1w",
    "rollup_1d_kst", "rollup_all_units", "rollup_cascade", "rollup_latest_1h",
    "stored_cascade_latest", "tape_candles_dedup", "tape_weeks_hot", "bithumb_parse",
    "upbit_parse", "upsert_latest_wins", "latest_per_symbol", "newest_n_per_symbol", "gaps",
    "closed_flag", "export_upbit", "retention_keep", "reconcile_diff", "reconcile_summary",
    "reconcile_csv", "stream_candles_1m", "stream_chain_1d", "stream_symbol_close",
]


REFRESH = "cascade_refresh"


def refresh_seconds(spark: SparkSession, sf_dir: str) -> float:
    """The incremental cascade alone, on a table that is full already: best of three."""
    table = CandleTable(spark, shared_folder(spark, "bench"))
    table.upsert(minutes(spark, sf_dir))
    jobs.rollup_all(table)
    taken = []
    for _ in range(4):
        start = time.perf_counter()
        jobs.rollup_latest(table, NOW)
        taken.append(time.perf_counter() - start)
    return round(min(taken[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    local = {
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SESSION_CONF, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    chosen = os.environ.get("BENCH_QUERIES")
    seconds = {}
    for name in chosen.split(",") if chosen else [*HEADLINE, REFRESH]:
        if name == REFRESH:
            seconds[name] = refresh_seconds(spark, sf_dir)
            continue
        for timed in (False, True):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
