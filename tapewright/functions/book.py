"""Order-book level arrays. A level is ``struct<price, quantity>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL = "struct<price:double,quantity:double>"


def parse_levels(raw: Column, levels: int | None) -> Column:
    """``[[price, quantity], ...]`` strings to typed levels, best ``levels`` first, or all.

    A level that is too short or does not parse is left out; the rest are kept.
    """
    pairs = F.coalesce(raw, F.array().cast("array<array<string>>"))
    typed = F.transform(
        pairs if levels is None else F.slice(pairs, 1, levels),
        lambda pair: F.struct(
            F.try_element_at(pair, F.lit(1)).try_cast("double").alias("price"),
            F.try_element_at(pair, F.lit(2)).try_cast("double").alias("quantity"),
        ),
    )
    return F.filter(typed, lambda lv: lv["price"].isNotNull() & lv["quantity"].isNotNull())


def top_price(levels: Column) -> Column:
    """Best price of a side, 0 when the side is empty."""
    return F.coalesce(F.try_element_at(levels, F.lit(1))["price"], F.lit(0.0))


def two_sided(bids: Column, asks: Column) -> Column:
    return (F.size(bids) > 0) & (F.size(asks) > 0)


def spread(bids: Column, asks: Column) -> Column:
    """Best ask minus best bid, 0 unless both sides have a level."""
    return F.when(two_sided(bids, asks), top_price(asks) - top_price(bids)).otherwise(0.0)


def side_quantity(levels: Column, depth: int | None) -> Column:
    """Total quantity of the best ``depth`` levels, or of all."""
    return F.aggregate(
        levels if depth is None else F.slice(levels, 1, depth), F.lit(0.0), lambda acc, lv: acc + F.coalesce(lv["quantity"], F.lit(0.0))
    )


def running_notional(levels: Column, depth: int) -> Column:
    """Levels with their position and the running price x quantity total.

    One fold over an array of at most ``depth`` levels, so no shuffle and no window.
    """
    kept = F.filter(
        F.slice(levels, 1, depth), lambda lv: lv["price"].isNotNull() & lv["quantity"].isNotNull()
    )
    empty = F.array().cast("array<struct<level:int,price:double,quantity:double,total:double>>")
    return F.aggregate(
        kept,
        empty,
        lambda acc, lv: F.concat(
            acc,
            F.array(
                F.struct(
                    (F.size(acc) + 1).alias("level"),
                    lv["price"].alias("price"),
                    lv["quantity"].alias("quantity"),
                    (
                        F.coalesce(F.try_element_at(acc, F.lit(-1))["total"], F.lit(0.0))
                        + lv["price"] * lv["quantity"]
                    ).alias("total"),
                )
            ),
        ),
    )


def max_quantity(bids: Column, asks: Column, depth: int, floor: float) -> Column:
    """Largest quantity on either side among the best ``depth`` levels, at least ``floor``."""
    sizes = F.transform(
        F.concat(F.slice(bids, 1, depth), F.slice(asks, 1, depth)),
        lambda lv: F.coalesce(lv["quantity"], F.lit(0.0)),
    )
    return F.greatest(F.coalesce(F.array_max(sizes), F.lit(floor)), F.lit(floor))
