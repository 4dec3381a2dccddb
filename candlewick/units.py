"""Candle unit catalogue: driver-side metadata, never data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS
WEEK_MS = 7 * DAY_MS

# The epoch fell on a Thursday, so Monday-based weeks start four days after it.
MONDAY_OFFSET_MS = 4 * DAY_MS

# Hours a calendar runs ahead of UTC.
TIMEZONE_SHIFT_MS = {"UTC": 0, "KST": 9 * HOUR_MS}


@dataclass(frozen=True)
class Unit:
    name: str
    ms: int
    base: str  # unit it is rolled up from
    period: str  # table partition granularity: WEEK, MONTH or YEAR
    export_name: str
    export_keep: int | None  # unit lengths kept in the export store, None keeps all

    def offset_ms(self, timezone: str = "UTC") -> int:
        """Start of the bucket grid relative to the epoch, in [0, ms)."""
        if timezone not in TIMEZONE_SHIFT_MS:
            raise ValueError(f"unsupported timezone: {timezone}")
        grid = MONDAY_OFFSET_MS if self.name == "1w" else 0
        return (grid - TIMEZONE_SHIFT_MS[timezone]) % self.ms


# Unit, length, base unit, table partition, export name, export depth.
UNITS: dict[str, Unit] = {
    unit.name: unit
    for unit in (
        Unit("1m", MINUTE_MS, "1m", "WEEK", "Min", 4000),
        Unit("3m", 3 * MINUTE_MS, "1m", "MONTH", "Min3", 2000),
        Unit("5m", 5 * MINUTE_MS, "1m", "MONTH", "Min5", 2000),
        Unit("10m", 10 * MINUTE_MS, "1m", "MONTH", "Min10", 2000),
        Unit("15m", 15 * MINUTE_MS, "1m", "MONTH", "Min15", 2000),
        Unit("30m", 30 * MINUTE_MS, "15m", "YEAR", "Min30", 2000),
        Unit("1h", HOUR_MS, "15m", "YEAR", "Hour", 2000),
        Unit("4h", 4 * HOUR_MS, "1h", "YEAR", "Hour4", 2000),
        Unit("1d", DAY_MS, "1h", "YEAR", "Day", 2000),
        Unit("1w", WEEK_MS, "1d", "YEAR", "Week", None),
    )
}

DERIVED_UNITS = [name for name in UNITS if name != "1m"]

# Newest candles compared per series by the reconciliation job.
CHECK_DEPTHS = {
    "upbit": {"1m": 120, "3m": 50, "15m": 10, "1h": 2, "1d": 2},
    "bithumb": {"1m": 120, "3m": 50, "10m": 15, "1h": 2, "1d": 2},
}

EPOCH = datetime(1970, 1, 1)


def to_utc_naive(moment: datetime) -> datetime:
    """Aware datetimes become naive UTC; naive ones already are."""
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def to_epoch_ms(moment: datetime) -> int:
    return (to_utc_naive(moment) - EPOCH) // timedelta(milliseconds=1)


def from_epoch(ms: int) -> datetime:
    return EPOCH + timedelta(milliseconds=ms)


def floor_time(moment: datetime, unit: str, timezone: str = "UTC") -> datetime:
    """Start of the bucket that holds ``moment``."""
    spec = UNITS[unit]
    since_epoch = to_epoch_ms(moment)
    start = since_epoch - (since_epoch - spec.offset_ms(timezone)) % spec.ms
    return from_epoch(start)


def lookback_start(now: datetime, unit: str, timezone: str = "UTC") -> datetime:
    """Start of the previous bucket: the incremental jobs redo it and the current one."""
    return floor_time(now, unit, timezone) - timedelta(milliseconds=UNITS[unit].ms)


def cascade_levels(bases: dict[str, str] | None = None) -> list[tuple[str, list[str]]]:
    """(base unit, derived units) pairs, each base complete before it is read.

    ``bases`` overrides single base units, for sources that serve some units natively.
    """
    base_of = {name: UNITS[name].base for name in DERIVED_UNITS} | (bases or {})
    levels: list[tuple[str, list[str]]] = []
    ready, waiting = {"1m"}, dict(base_of)
    while waiting:
        level = {name: base for name, base in waiting.items() if base in ready}
        if not level:
            raise ValueError(f"units without a reachable base: {sorted(waiting)}")
        for base in dict.fromkeys(level.values()):
            levels.append((base, [name for name in level if level[name] == base]))
        ready |= level.keys()
        waiting = {name: base for name, base in waiting.items() if name not in level}
    return levels


def covering_unit(units: list[str]) -> str:
    """The shortest unit whose buckets hold whole buckets of all these units."""
    return next(
        name for name, unit in UNITS.items() if all(unit.ms % UNITS[u].ms == 0 for u in units)
    )
