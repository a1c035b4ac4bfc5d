"""Symbol names and topic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_in(symbol: Column, quote: str) -> Column:
    return F.endswith(symbol, F.lit(quote))


def base_asset(symbol: Column, quote: str) -> Column:
    """Symbol without its trailing quote asset; unchanged when it has none."""
    return F.when(
        quoted_in(symbol, quote), F.substring(symbol, F.lit(1), F.length(symbol) - len(quote))
    ).otherwise(symbol)


def stream_symbol(stream: Column) -> Column:
    """Upper-case symbol of a stream name such as ``abcusdt@depth20``."""
    return F.upper(F.trim(F.split_part(stream, F.lit("@"), F.lit(1))))


def candle_key(symbol: Column, interval: Column) -> Column:
    return F.concat_ws("_", symbol, interval)
