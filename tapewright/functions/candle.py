"""Candle arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_start(time_ms: Column, width_ms: int) -> Column:
    """Start of the candle a millisecond time falls into, in whole-number arithmetic."""
    return time_ms - F.pmod(time_ms, F.lit(width_ms).cast("bigint"))


def event_ts(time_ms: Column) -> Column:
    """Millisecond epoch to timestamp without going through a double."""
    return F.timestamp_millis(time_ms)


def change_pct(new: Column, old: Column) -> Column:
    """Change from ``old`` to ``new`` in percent; NULL when ``old`` is zero."""
    return F.try_divide(new - old, old) * 100


def tick_order(time_ms: Column, trade_id: Column) -> Column:
    """Order of trades as one decimal: time first, trade id second, for every 64-bit id.

    ``min_by``/``max_by`` over a number plan as a hash aggregate, over a struct as a sort
    aggregate that sorts the tape before combining it.
    """
    ident = F.coalesce(trade_id, F.lit(0)).cast("decimal(20,0)")
    # A time that is no time (beyond 18 digits) orders nothing. Ids from -2**63 to 2**63 - 1 stay within their millisecond.
    return time_ms.try_cast("decimal(18,0)") * F.lit(str(2 * 10**19)).cast("decimal(20,0)") + ident


def direction(open_: Column, close: Column) -> Column:
    """Candle type; an unchanged candle counts as bullish."""
    return F.when(close >= open_, "bullish").otherwise("bearish")


def upper_shadow() -> Column:
    return F.col("high") - F.greatest("open", "close")


def lower_shadow() -> Column:
    return F.least("open", "close") - F.col("low")


def vwap(quote_volume: Column, volume: Column) -> Column:
    """Volume-weighted price; NULL for a candle without volume."""
    return F.try_divide(quote_volume, volume)


def banded(value: Column, bands: list[tuple[float, str]], floor: str) -> Column:
    """Label of the first band whose lower bound ``value`` reaches."""
    chain = None
    for low, label in bands:
        test = value >= low
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return F.lit(floor) if chain is None else chain.otherwise(floor)
