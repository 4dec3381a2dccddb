"""The candle, export and trade stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import period_start, ts_literal
from candlewick.functions.times import from_epoch_ms_sql, period_of, period_start_sql
from candlewick.operators.export import retention_cutoffs
from candlewick.operators.series import depth_of, newest_n
from candlewick.schemas import CANDLE, CANDLE_KEYS, EXPORT, SERIES
from candlewick.sources.upserts import UpsertTable
from candlewick.units import EPOCH, UNITS, from_epoch, to_epoch_ms, to_utc_naive

# Readers of the newest rows look this many times further back at each step.
WIDEN = 4
# Readers go back no further.
OLDEST = datetime(1001, 1, 1)
PERIOD_SPANS = {"WEEK": timedelta(days=7), "MONTH": timedelta(days=31), "YEAR": timedelta(days=366)}


@dataclass(frozen=True)
class CandleTable(UpsertTable):
    """Candles of all exchanges and units, keyed (exchange, unit, timestamp, symbol)."""

    schema: T.StructType = CANDLE
    keys: tuple[str, ...] = tuple(CANDLE_KEYS)
    partitions: tuple[str, ...] = ("exchange", "unit", "p")
    series: tuple[str, ...] = ("unit", "exchange", "symbol")
    sort: tuple[str, ...] = ("symbol", "timestamp")
    first_values: tuple[str, ...] = ("created_at",)

    def period(self) -> Column:
        return period_start("timestamp")

    def upsert(self, rows: DataFrame, version: int | None = None, writer: str = "") -> None:
        """As the base. A 1m candle's ``created_at`` defaults to the time of its first write,
        which later writes keep; candles of other units have none unless it is given."""
        now = F.when(F.col("unit") == "1m", F.current_timestamp().cast("timestamp_ntz"))
        created = F.coalesce("created_at", now) if "created_at" in rows.columns else now
        super().upsert(rows.withColumn("created_at", created), version, writer)

    def candles(
        self,
        exchange: str | None = None,
        units: Sequence[str] | None = None,
        start: datetime | None = None,
        end: datetime | None = None,
        symbol: str | None = None,
        periods: Sequence[date] | None = None,
    ) -> DataFrame:
        """Current candles with ``start <= timestamp < end``, pruned to their partitions; of some
        ``periods`` only, if these are given."""
        conditions = []
        if exchange is not None:
            conditions.append(F.col("exchange") == exchange)
        if symbol is not None:
            conditions.append(F.col("symbol") == symbol)
        if units is not None:
            conditions.append(F.col("unit").isin(*units))
        if periods is not None:
            conditions.append(F.col("p").isin(list(periods)))
        names = list(units or UNITS)
        folders = None
        if units is not None or exchange is not None:
            folders = f"exchange={exchange or '*'}/unit={{{','.join(names)}}}/p=*"
        if start is not None:
            first_year = min(period_of(start, name).year for name in names)
            folders = (f"exchange={exchange or '*'}/unit={{{','.join(names)}}}"
                       f"/p={{{','.join(years_from(first_year))}}}-*")
            conditions += [F.col("timestamp") >= ts_literal(start),
                           any_period(names, lambda name: F.col("p") >= F.lit(period_of(start, name)))]
        if end is not None:
            conditions += [F.col("timestamp") < ts_literal(end),
                           any_period(names, lambda name: F.col("p") <= F.lit(period_of(end, name)))]
        return self.read(*conditions, folders=folders)

    def newest(self, depth: int | dict[str, dict[str, int]], now: datetime | None = None) -> DataFrame:
        """At least the newest candles of every series to ``depth`` (rows, or rows by exchange and
        unit), from the partitions that can hold them.

        Periods are read newest first, WIDEN times as many at each step, until every series has
        enough rows or is read from its oldest period on. ``now`` is where reading starts; candles
        after it are read as well. Only the units that still lack rows are collected.
        """
        known = self.known_series().withColumn("wanted", depth_of(depth)).where("wanted > 0")
        return self.since(newest_starts(known, self.since, SERIES, now))

    def since(self, starts: dict[str, datetime]) -> DataFrame:
        """Candles of each unit from its own start on."""
        parts = [self.candles(units=[unit], start=start) for unit, start in sorted(starts.items())]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def latest(self, exchange: str, unit: str, now: datetime | None = None) -> DataFrame:
        """Newest candle per symbol, without a scan of the history."""
        rows = self.newest({exchange: {unit: 1}}, now)
        return newest_n(rows.where(F.col("exchange") == exchange), 1)


def newest_starts(
    known: DataFrame, since: Callable[[dict[str, datetime]], DataFrame], series: Sequence[str],
    now: datetime | None, units: dict[str, str] | None = None,
) -> dict[str, datetime]:
    """For each unit, from when on ``since`` has the rows ``wanted`` of every ``known`` series.

    Reading starts at the beginning of a period, so that a series' oldest period is read whole.
    ``units`` says which catalogue unit a unit's name in the table stands for.
    """
    now = to_utc_naive(now or datetime.now(UTC))
    units = units or {name: name for name in UNITS}
    known = known.persist()
    try:
        most = {row["unit"]: row["n"] for row in known.groupBy("unit").agg(F.max("wanted").alias("n")).collect()}
        reach, starts = {}, {}
        for unit, rows in most.items():
            spec = UNITS[units[unit]]
            wide = min(spec.ms * rows, max(to_epoch_ms(now), 0))
            reach[unit] = now - max(PERIOD_SPANS[spec.period], timedelta(milliseconds=wide))
        lacking = set(reach)
        while lacking:
            starts |= {unit: period_begin(reach[unit], units[unit]) for unit in lacking}
            counted = since({unit: starts[unit] for unit in lacking}).groupBy(*series).agg(F.count("*").alias("n"))
            first = F.create_map(*(
                x for unit in lacking for x in (F.lit(unit), F.lit(starts[unit].date()))
            ))[F.col("unit")]
            short = known.where(F.col("unit").isin(*lacking)).join(counted, list(series), "left").where(
                (F.coalesce("n", F.lit(0)) < F.col("wanted")) & (F.col("oldest") < first)
            )
            found = {row["unit"] for row in short.select("unit").distinct().collect()}
            lacking = {unit for unit in found if reach[unit] > OLDEST}
            for unit in lacking:
                further = EPOCH if now <= EPOCH else max(EPOCH, now - (now - reach[unit]) * WIDEN)
                reach[unit] = further if further < reach[unit] else OLDEST
    finally:
        known.unpersist()
    return starts


def period_begin(moment: datetime, unit: str) -> datetime:
    return datetime.combine(period_of(moment, unit), time())


def years_from(year: int) -> list[str]:
    """Path patterns that match the four-digit years from ``year`` on."""
    digits = f"{year:04}"
    later = [
        f"{digits[:i]}[{int(digit) + 1}-9]{'?' * (3 - i)}"
        for i, digit in enumerate(digits) if digit != "9"
    ]
    return [digits, *later]


def any_period(units: Sequence[str], bound) -> Column:
    """Bound on ``p`` for each unit's own partition granularity."""
    by_period: dict[str, list[str]] = {}
    for name in units:
        by_period.setdefault(UNITS[name].period, []).append(name)
    if len(by_period) == 1:
        return bound(units[0])
    terms = [F.col("unit").isin(*names) & bound(names[0]) for names in by_period.values()]
    return reduce(Column.__or__, terms)


UNIT_OF_EXPORT = {unit.export_name: name for name, unit in UNITS.items()}


@dataclass(frozen=True)
class ExportTable(UpsertTable):
    """Export candles of all markets and units, keyed (unit, market, code, tms)."""

    schema: T.StructType = EXPORT
    keys: tuple[str, ...] = ("unit", "market", "code", "tms")
    partitions: tuple[str, ...] = ("unit", "market", "p")
    series: tuple[str, ...] = ("unit", "market", "code")
    sort: tuple[str, ...] = ("code", "tms")

    def period(self) -> Column:
        at = from_epoch_ms_sql("tms")
        branches = " ".join(
            f"WHEN '{export_name}' THEN {period_start_sql(at, name)}"
            for export_name, name in UNIT_OF_EXPORT.items()
        )
        return F.expr(f"CASE unit {branches} END")

    def newest_closed(
        self, market: str, units: Sequence[str], n: int, now: datetime | None = None
    ) -> DataFrame:
        """Newest ``n`` rows per code and unit, without the newest of all: it is still open.

        Periods are read newest first, from ``now`` on, as by ``CandleTable.newest``.
        """
        known = self.known_series().where(
            (F.col("market") == market) & F.col("unit").isin(*units)
        ).withColumn("wanted", F.lit(n + 1))
        starts = newest_starts(
            known, lambda found: self.since(market, found), self.series, now, UNIT_OF_EXPORT
        )
        return newest_n(self.since(market, starts), n + 1, skip=1, series=self.series, time="tms")

    def since(self, market: str, starts: dict[str, datetime]) -> DataFrame:
        """Rows of a market and of each unit from its own start on."""
        parts = []
        for unit, start in sorted(starts.items()):
            first = period_of(start, UNIT_OF_EXPORT[unit])
            parts.append(self.read(
                F.col("market") == market, F.col("unit") == unit,
                F.col("p") >= F.lit(first), F.col("tms") >= to_epoch_ms(start),
                folders=f"unit={unit}/market={market}/p={{{','.join(years_from(first.year))}}}-*",
            ))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def delete_expired(self, now: datetime) -> dict[str, int]:
        """Deletes rows older than their unit keeps and returns how many per unit.

        Of the partitions that start before the bound, the one it falls in is rewritten without its
        old rows and the others are overwritten with none. Partition counts are collected: their
        number grows with units, markets and periods, not with rows.
        """
        cutoffs = retention_cutoffs(now)
        deleted: dict[str, int] = dict.fromkeys(cutoffs, 0)
        bounds = " ".join(f"WHEN '{unit}' THEN {cutoff}L" for unit, cutoff in cutoffs.items())
        old = F.col("tms") < F.expr(f"CASE unit {bounds} END")
        reached = reduce(Column.__or__, [
            (F.col("unit") == unit)
            & (F.col("p") <= F.lit(period_of(from_epoch(cutoff), UNIT_OF_EXPORT[unit])))
            for unit, cutoff in cutoffs.items()
        ])
        with self.writing:
            parts = self.raw().where(reached).groupBy(*self.partitions).agg(
                F.count_if(old).alias("n"), F.count_if(~old).alias("kept")
            ).where("n > 0").collect()
            crossed = [row for row in parts if row["kept"]]
            if crossed:
                self._replace(self._spread(self._touched(crossed).where(~old)))
            for row in parts:
                if not row["kept"]:
                    self._empty(row)
        for row in parts:
            deleted[row["unit"]] += row["n"]
        return deleted

    def _empty(self, partition) -> None:
        """Overwrites one partition with no rows, which dynamic overwriting leaves alone."""
        folder = "/".join(f"{name}={partition[name]}" for name in self.partitions)
        inside = [f for f in self.stored_schema.fields if f.name not in self.partitions]
        self.spark.createDataFrame([], T.StructType(inside)).write.mode("overwrite").parquet(
            f"{self.path}/{folder}"
        )


def append_trades(trades: DataFrame, path: str) -> None:
    """Appends trades with their ingest time, partitioned by exchange and day."""
    (
        stamped_trades(trades).hint("rebalance", "exchange", "day")
        .write.mode("append").partitionBy("exchange", "day").parquet(path)
    )


def stamped_trades(trades: DataFrame) -> DataFrame:
    return trades.withColumns({
        "created_at": F.current_timestamp().cast("timestamp_ntz"),
        "day": F.col("timestamp").cast("date"),
    })
