"""Exact sums and fixed-place rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Volumes are summed to this many decimals, and once more to as many below them.
VOLUME_PLACES = 8
HIGH = 2**31
# Larger values are no longs.
MOST_VALUE = 9.2e18
# From so many multiples of HIGH (5.9e20) on, decimals do not hold a sum with all of its places.
MOST_HIGHS = 2**38


def exact_sum(value: str) -> Column:
    """Order-independent sum of a double column to sixteen decimals.

    A plain double sum depends on row order, and a decimal sum is about twice as slow because
    its buffer is not a primitive. Multiples of 2 ** 31, whole units below, 1e-8 fractions and
    1e-16 fractions are each summed as a long, which stays in the hash aggregate's mutable buffer
    and does not overflow; they meet once per group. The last part is what eight decimals leave
    over, unless the double itself is not that exact. Values must be below ``MOST_VALUE``.
    """
    return F.expr(joined_parts_sql(*(
        f"sum({part(value)})" for part in (high_sql, low_sql, parts_sql, rest_sql)
    )))


def high_sql(value: str) -> str:
    return f"floor({value} / {HIGH}D)"


def low_sql(value: str) -> str:
    return f"(floor({value}) - floor({value} / {HIGH}D) * {HIGH}L)"


def _scaled(value: str) -> str:
    return f"(({value} - floor({value})) * 1E{VOLUME_PLACES}D)"


def parts_sql(value: str) -> str:
    return f"CAST(round({_scaled(value)}) AS BIGINT)"


def rest_sql(value: str) -> str:
    """1e-16 units beyond ``parts_sql``; zero within the spacing of doubles of this size."""
    left = f"({_scaled(value)} - round({_scaled(value)}))"
    noise = f"(abs({value}) + 1D) * {2.0**-51 * 10**VOLUME_PLACES!r}D"
    return (
        f"CASE WHEN abs({left}) <= {noise} AND abs({value}) >= 1E-{VOLUME_PLACES}D THEN 0L"
        f" ELSE CAST(round({left} * 1E{VOLUME_PLACES}D) AS BIGINT) END"
    )


def joined_parts_sql(high: str, low: str, parts: str, rest: str) -> str:
    """The parts as one double.

    Where not all places fit a decimal, doubles are whole and so is the middle between any two:
    what lies below one unit counts as a half if there is any, which rounds the same way.
    """
    step = f"0.{'1'.zfill(VOLUME_PLACES)}BD"
    fine = f"0.{'1'.zfill(2 * VOLUME_PLACES)}BD"
    fits = f"abs({high}) < {MOST_HIGHS}L"
    high, low, parts, rest = (f"CAST({part} AS DECIMAL(20, 0))" for part in (high, low, parts, rest))
    whole = f"({high} * {HIGH}BD + {low})"
    below = f"({parts} * {step} + {rest} * {fine})"
    all_places = f"CAST({whole} AS DECIMAL(21, 0)) + {parts} * {step} + {rest} * {fine}"
    halves = f"{whole} + floor({below}) + IF({below} > floor({below}), 0.5BD, 0.0BD)"
    return f"CASE WHEN {fits} THEN CAST({all_places} AS DOUBLE) ELSE CAST({halves} AS DOUBLE) END"


def to_fixed(value: Column, places: int) -> Column:
    """Non-negative double rounded to ``places`` on its exact binary value, halves up.

    ``round`` works on the shortest decimal form instead, which can sit on a half where the
    value itself does not. Scaling rounds too, but never across a half, so only a scaled value
    that lands on one needs its rounding error, which splitting the value recovers exactly.
    A value so large that it has no such decimals stays as it is.
    """
    scale = F.lit(10.0**places)
    scaled = value * scale
    below = F.floor(scaled)
    spread = value * F.lit(2.0**27 + 1)
    high = spread - (spread - value)
    error = (high * scale - scaled) + (value - high) * scale
    over = scaled - below
    up = (over > 0.5) | ((over == 0.5) & (error >= 0))
    fine = value < 2.0**52 / 10.0**places
    return F.when(fine, (below + F.when(up, 1).otherwise(0)) / scale).otherwise(value)


def as_mark(flag: Column) -> Column:
    return F.when(flag, F.lit("o")).otherwise(F.lit("x"))
