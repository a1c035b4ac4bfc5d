"""Order-book views. Every fold runs over one snapshot's bounded level arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import book as fn
from tapewright.operators.blocks import BLOCK_MS, block_window, drop_borrowed, with_borders
from tapewright.schemas import BOOK_LEVELS, DISPLAY_LEVELS

#: Smallest quantity a level's share is measured against.
QUANTITY_FLOOR = 0.0001


def _both_sides(books: DataFrame, rows) -> DataFrame:
    """Rows per level, made by ``rows(levels column)``, of both sides in one pass."""
    sides = F.array(
        *(F.struct(F.lit(side).alias("side"), rows(F.col(column)).alias("levels")) for side, column in (("bid", "bids"), ("ask", "asks")))
    )
    return books.withColumn("_s", F.explode(sides)).withColumn("_l", F.explode("_s.levels"))


def cumulative(books: DataFrame, levels: int = BOOK_LEVELS) -> DataFrame:
    """One row per level with the running notional of its side."""
    exploded = _both_sides(books, lambda side: fn.running_notional(side, levels))
    return exploded.select("symbol", "timestamp", "_s.side", "_l.level", "_l.price", "_l.quantity", "_l.total")


def imbalance(books: DataFrame, levels: int = DISPLAY_LEVELS) -> DataFrame:
    """Quantity per side and the bid share in percent; 50 for an empty book."""
    sums = books.select(
        "symbol",
        "timestamp",
        fn.side_quantity(F.col("bids"), levels).alias("bid_quantity"),
        fn.side_quantity(F.col("asks"), levels).alias("ask_quantity"),
    )
    total = F.col("bid_quantity") + F.col("ask_quantity")
    share = F.when(total > 0, F.try_divide(F.col("bid_quantity"), total) * 100).otherwise(50.0)
    return sums.withColumn("bid_pct", share)


def depth_norm(books: DataFrame, levels: int = DISPLAY_LEVELS) -> DataFrame:
    """Each shown level's quantity in percent of the snapshot's largest."""
    largest = books.withColumn("_max", fn.max_quantity(F.col("bids"), F.col("asks"), levels, QUANTITY_FLOOR))
    numbered = _both_sides(
        largest,
        lambda side: F.transform(
            F.slice(side, 1, levels),
            lambda lv, i: F.struct((i + 1).alias("level"), lv["price"].alias("price"), lv["quantity"].alias("quantity")),
        ),
    )
    share = F.coalesce(F.col("_l.quantity"), F.lit(0.0)) / F.col("_max") * 100
    return numbered.select(
        "symbol", "timestamp", "_s.side", "_l.level", "_l.price", "_l.quantity", share.alias("depth_pct")
    )


def dedupe(
    snapshots: DataFrame, order: tuple[str, ...] = ("timestamp",), block_ms: int = BLOCK_MS
) -> DataFrame:
    """Snapshots whose timestamp differs from the one before them of the same symbol.

    Snapshots that ``order`` leaves equal are told apart by their prices, so the same one
    is kept on every run.
    """
    order = (*order, *(c for c in ("best_bid", "best_ask") if c in snapshots.columns and c not in order))
    block = F.expr(f"{order[0]} div {block_ms}")
    snapshots = snapshots.where(F.col(order[0]).isNotNull())  # a snapshot without a time follows none
    bordered = with_borders(snapshots, ["symbol"], list(order), block, back=1)
    before = F.lag("timestamp").over(block_window(["symbol"], list(order)))
    changed = drop_borrowed(bordered.withColumn("_before", before))
    return changed.where(~F.col("timestamp").eqNullSafe(F.col("_before"))).drop("_before")
