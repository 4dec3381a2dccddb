"""Runs a job: ``python -m candlewick rollup-latest --candles PATH [--export PATH]``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import UTC, datetime

from candlewick.operators.fold import PROFILES
from candlewick.plans import jobs
from candlewick.schemas import ARRAY_CANDLE, REST_CANDLE
from candlewick.session import build_session
from candlewick.sources.history import rest_to_candles, rest_to_export
from candlewick.sources.tables import CandleTable, ExportTable
from candlewick.sources.trades import (
    read_trade_files,
    stream_messages,
    stream_ordered_messages,
    trades_from_batches,
    trades_from_singles,
)
from candlewick.streaming.candles import LateTrades
from candlewick.streaming.late import landed_trades, late_trades
from candlewick.units import CHECK_DEPTHS


def both(action):
    return lambda a: [action(table) for table in (a.candles, a.export) if table]


def load_history(a) -> None:
    rows = a.spark.read.schema(ARRAY_CANDLE).json(a.source)
    jobs.load_history(rows, a.candles, native_grid=a.native_grid)


def stream(a) -> None:
    """Messages of the exchange to 1m candles; ``--once`` drains what is there and stops."""
    if PROFILES[a.exchange].repeats:
        trades = trades_from_singles(stream_messages(a.spark, a.source), a.exchange)
    else:
        trades = trades_from_batches(stream_ordered_messages(a.spark, a.source), a.exchange)
    every = None if a.once else "3 seconds"
    if a.landing:
        queries = jobs.stream_candles_and_late(
            a.spark, trades, a.exchange, a.candles, a.landing, a.checkpoint, every, a.lateness
        )
        for query in queries:
            query.awaitTermination()
        print("late trades:", late_trades(a.spark, a.landing).count())
        return
    counts = LateTrades()
    a.spark.streams.addListener(counts)
    jobs.stream_candles(
        a.spark, trades, a.exchange, a.candles, a.checkpoint, every=every, lateness=a.lateness,
    ).awaitTermination()
    print("late trades:", sum(counts.dropped.values()))


def repair(a) -> None:
    """Late trades of the landing, from the trades that it holds."""
    late = late_trades(a.spark, a.landing, a.after)
    jobs.repair(a.candles, late, landed_trades(a.spark, a.landing), a.exchange)


def reconcile(a) -> None:
    served = a.spark.read.schema(REST_CANDLE).json(a.source)
    depth = json.loads(a.depth) if a.depth else CHECK_DEPTHS
    jobs.reconcile(a.candles, rest_to_candles(served, a.exchange), depth, a.report)


def reconcile_export(a) -> None:
    served = rest_to_export(a.spark.read.schema(REST_CANDLE).json(a.source), a.exchange)
    units = tuple(r["unit"] for r in served.select("unit").distinct().orderBy("unit").collect())
    jobs.reconcile_export(a.export, served, a.exchange.upper(), units, a.limit, a.report)


JOBS = {
    "create": both(lambda table: table.create()),
    "load-trades": lambda a: jobs.load_trades(
        read_trade_files(a.spark, a.source, a.exchange), a.exchange, a.candles),
    "load-history": load_history,
    "rollup-latest": lambda a: jobs.rollup_latest(a.candles, a.now, a.timezone),
    "rollup-all": lambda a: jobs.rollup_all(a.candles, a.timezone),
    "rollup-history": lambda a: jobs.rollup_history(
        a.candles, a.exchange, frozenset(a.native.split(",")), a.timezone),
    "stream": stream,
    "repair": repair,
    "refresh-export": lambda a: print(jobs.refresh_export(a.candles, a.export, a.now)),
    "export-history": lambda a: jobs.export_history(a.candles, a.export, a.limit),
    "export-latest": lambda a: jobs.export_latest(a.candles, a.export, a.now),
    "retention": lambda a: print(jobs.apply_retention(a.export, a.now)),
    "reconcile": reconcile,
    "reconcile-export": reconcile_export,
    "find-gaps": lambda a: jobs.find_gaps(a.candles).write.mode("overwrite").json(a.report),
}
NEEDS = {
    "load-trades": ["candles", "source", "exchange"], "load-history": ["candles", "source"],
    "rollup-latest": ["candles"], "rollup-all": ["candles"],
    "rollup-history": ["candles", "exchange", "native"],
    "stream": ["candles", "source", "exchange", "checkpoint"],
    "repair": ["candles", "exchange", "landing"], "refresh-export": ["candles", "export"],
    "export-history": ["candles", "export"], "export-latest": ["candles", "export"],
    "retention": ["export"], "reconcile": ["candles", "source", "exchange", "report"],
    "reconcile-export": ["export", "source", "exchange", "report"],
    "find-gaps": ["candles", "report"],
}


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="candlewick", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--candles", help="candle table path")
    parser.add_argument("--export", help="export table path")
    parser.add_argument("--source", help="landed files: trades, positional or REST candles, messages")
    parser.add_argument("--exchange", choices=PROFILES)
    parser.add_argument("--native", help="units that the exchange serves, with commas")
    parser.add_argument("--native-grid", action="store_true", help="only candles on their grid")
    parser.add_argument("--checkpoint", help="progress of the stream")
    parser.add_argument("--landing", help="folder where the stream lands trades, late ones apart")
    parser.add_argument("--after", type=int, default=-1, help="last landed batch that is repaired already")
    parser.add_argument("--lateness", default="1 minute", help="how long the stream waits for trades")
    parser.add_argument("--once", action="store_true", help="drain what has landed and stop")
    parser.add_argument("--report", help="output path of find-gaps and of the comparisons")
    parser.add_argument("--depth", help="JSON of candles compared per exchange and unit")
    parser.add_argument("--now", type=datetime.fromisoformat, default=datetime.now(UTC))
    parser.add_argument("--timezone", choices=["UTC", "KST"], default="UTC")
    parser.add_argument("--limit", type=int, default=2000, help="candles exported or compared per series")
    args = parser.parse_args(argv)
    missing = [name for name in NEEDS.get(args.job, []) if getattr(args, name) is None]
    if missing:
        parser.error(f"{args.job} needs --{', --'.join(missing)}")
    args.spark = build_session()
    args.candles = args.candles and CandleTable(args.spark, args.candles)
    args.export = args.export and ExportTable(args.spark, args.export)
    JOBS[args.job](args)


if __name__ == "__main__":
    main()
