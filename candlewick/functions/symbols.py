"""Market codes and standard symbols."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_of(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("/"), F.lit(1))


def quote_of(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("/"), F.lit(2))


def code_to_symbol(exchange: str, code: Column) -> Column:
    """'KRW-BTC' (upbit) or 'BTC_KRW' (bithumb) to 'BTC/KRW'."""
    if exchange == "upbit":
        dash = F.lit("-")
        base, quote = F.split_part(code, dash, F.lit(2)), F.split_part(code, dash, F.lit(1))
        return F.concat_ws("/", base, quote)
    if exchange == "bithumb":
        # Only the first underscore separates base and quote.
        return F.regexp_replace(code, "^([^_]*)_", "$1/")
    raise ValueError(f"unknown exchange: {exchange}")


def dashed_code(symbol: Column) -> Column:
    return F.concat_ws("-", quote_of(symbol), base_of(symbol))


def underscored_code(symbol: Column) -> Column:
    return F.regexp_replace(symbol, "^([^/]*)/", "$1_")


def market_code(exchange: Column, symbol: Column) -> Column:
    """Export code by exchange; other markets keep the standard symbol."""
    return (
        F.when(exchange == "upbit", dashed_code(symbol))
        .when(exchange == "bithumb", underscored_code(symbol))
        .otherwise(symbol)
    )


def join_ids(exchange: str, base: Column, quote: Column) -> tuple[Column, Column]:
    """(standard symbol, market code) from separate base and quote ids."""
    symbol = F.concat_ws("/", base, quote)
    return symbol, market_code(F.lit(exchange), symbol)
