"""Bucket, alignment and epoch expressions.

Arguments called ``ts``, ``ms`` and ``unit_col`` are column names or SQL text: one parsed
expression costs one call into the JVM however many nodes it has, which is what the short
incremental jobs spend their time on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.units import MINUTE_MS, UNITS, to_utc_naive


def ts_literal(moment: datetime) -> Column:
    """Zone-less literal; it folds to a constant, so comparisons reach the Parquet scan."""
    return F.lit(to_utc_naive(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_ms_sql(ts: str) -> str:
    return f"unix_millis(CAST({ts} AS TIMESTAMP))"


def from_epoch_ms_sql(ms: str) -> str:
    return f"CAST(timestamp_millis({ms}) AS TIMESTAMP_NTZ)"


def floored_sql(ms: str, unit: str, timezone: str = "UTC") -> str:
    spec = UNITS[unit]
    return f"({ms} - pmod({ms} - {spec.offset_ms(timezone)}L, {spec.ms}L))"


def by_unit_sql(unit_col: str, value_of: Callable[[str], str]) -> str:
    """CASE over the catalogue for rows that carry their unit as a column."""
    branches = " ".join(f"WHEN '{name}' THEN {value_of(name)}" for name in UNITS)
    return f"CASE {unit_col} {branches} END"


def epoch_ms(ts: str) -> Column:
    return F.expr(epoch_ms_sql(ts))


def from_epoch_ms(ms: str) -> Column:
    return F.expr(from_epoch_ms_sql(ms))


def tumbling(ts: Column | str, unit: str, timezone: str = "UTC") -> Column:
    """The ``[start, end)`` bucket of a unit; weeks start on Monday, KST days at 15:00 UTC."""
    spec = UNITS[unit]
    return F.window(
        ts, f"{spec.ms} milliseconds", startTime=f"{spec.offset_ms(timezone)} milliseconds"
    )


def bucket_start(ts: str, unit: str, timezone: str = "UTC") -> Column:
    return tumbling(ts, unit, timezone).getField("start")


def bucket_ms(ts: str, unit: str, timezone: str = "UTC") -> Column:
    """Bucket start as epoch ms; unlike ``window`` several fit in one projection."""
    return F.expr(floored_sql(epoch_ms_sql(ts), unit, timezone))


def unit_ms_sql(unit_col: str = "unit") -> str:
    return by_unit_sql(unit_col, lambda name: f"{UNITS[name].ms}L")


def unit_bucket_start(ts: str, unit_col: str = "unit", timezone: str = "UTC") -> Column:
    ms = epoch_ms_sql(ts)
    start = by_unit_sql(unit_col, lambda name: floored_sql(ms, name, timezone))
    return F.expr(from_epoch_ms_sql(start))


def is_aligned(ts: str, unit: str | None = None, unit_col: str = "unit") -> Column:
    """True when the timestamp, seconds ignored, is a bucket start of its unit."""
    ms = epoch_ms_sql(ts)
    minute = f"({ms} - pmod({ms}, {MINUTE_MS}L))"
    if unit is not None:
        return F.expr(f"{floored_sql(minute, unit)} = {minute}")
    return F.expr(by_unit_sql(unit_col, lambda name: f"{floored_sql(minute, name)} = {minute}"))


def period_start_sql(ts: str, unit: str) -> str:
    return f"trunc(CAST({ts} AS DATE), '{UNITS[unit].period}')"


def period_start(ts: str, unit: str | None = None, unit_col: str = "unit") -> Column:
    """First day of the table partition (week, month or year) that holds the timestamp."""
    if unit is not None:
        return F.expr(period_start_sql(ts, unit))
    return F.expr(by_unit_sql(unit_col, lambda name: period_start_sql(ts, name)))


def period_of(moment: datetime, unit: str) -> date:
    """``period_start`` of a driver-side bound."""
    day = to_utc_naive(moment).date()
    if UNITS[unit].period == "WEEK":
        return day - timedelta(days=day.weekday())
    return day.replace(day=1) if UNITS[unit].period == "MONTH" else day.replace(month=1, day=1)
