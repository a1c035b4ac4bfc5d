"""Rankings, sentiment, ticks and pair discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.functions import candle
from tapewright.functions.symbols import base_asset, quoted_in
from tapewright.operators.blocks import BLOCK_MS, block_window, drop_borrowed, with_borders
from tapewright.schemas import (
    MAX_PAIRS,
    MIN_PAIR_VOLUME,
    QUOTE_ASSET,
    SENTIMENT_BANDS,
    SENTIMENT_FLOOR,
)

def first_last(trades: DataFrame, keys: list[str], time: str = "trade_time", value: str = "price") -> DataFrame:
    """First and last ``value`` per key by (time, trade id), with row count and last time.

    One hash aggregate: the tape is combined before it is shuffled and never sorted. Rows
    without a time are counted, but are neither first nor last.
    """
    order = candle.tick_order(F.col(time), F.col("trade_id"))
    return trades.groupBy(*keys).agg(
        F.min_by(value, order).alias("first"),
        F.max_by(value, order).alias("last"),
        F.max(time).alias("last_time"),
        F.count("*").alias("rows"),
    )


def session_change(trades: DataFrame, since: int | None = None) -> DataFrame:
    """Open, close and percent change per symbol since a start time."""
    if since is not None:
        trades = trades.where(F.col("trade_time") >= since)
    ends = first_last(trades.where(F.col("trade_time").isNotNull()), ["symbol"])
    return ends.select(
        "symbol",
        F.col("first").alias("open"),
        F.col("last").alias("close"),
        F.col("last_time").alias("last_update"),
        candle.change_pct(F.col("last"), F.col("first")).alias("percent_change"),
    )


def ranking(changes: DataFrame) -> DataFrame:
    """The ranking layout served to clients."""
    return changes.select(
        "symbol", F.col("close").alias("price"), "percent_change", F.col("last_update").alias("timestamp")
    )


def top_n(ranked: DataFrame, n: int = 1000, losers: bool = False) -> DataFrame:
    """Best (or worst) ``n`` symbols by percent change."""
    change = F.col("percent_change")
    return ranked.orderBy(change.asc_nulls_last() if losers else change.desc_nulls_last(), "symbol").limit(n)


def top_n_strict(ranked: DataFrame, n: int = 8, losers: bool = False) -> DataFrame:
    """Numbered best ``n`` symbols that really gained (or lost).

    The position is taken from the ``n`` kept rows only: gathered into one array and
    laid out again, so nothing is numbered before the limit.
    """
    change = F.col("percent_change")
    top = top_n(ranked.where(change < 0 if losers else change > 0), n, losers)
    sort_key = change if losers else -change
    row = F.struct(sort_key.alias("_k"), F.col("symbol").alias("_s"), *top.columns)
    packed = top.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return packed.select(F.posexplode("rows").alias("position", "r")).select(
        (F.col("position") + 1).alias("position"), *(f"r.{c}" for c in top.columns)
    )


def sentiment(ranked: DataFrame) -> DataFrame:
    """Gainers, losers, share of gainers (rounded half up, 50 when empty) and its label."""
    change = F.col("percent_change")
    counts = ranked.agg(
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.count("*").alias("total"),
    )
    share = F.floor(F.try_divide("gainers", "total") * 100 + 0.5)
    scored = counts.withColumn("score", F.coalesce(share, F.lit(50)).cast("bigint"))
    return scored.withColumn("label", candle.banded(F.col("score"), SENTIMENT_BANDS, SENTIMENT_FLOOR))


def tick_direction(
    ticks: DataFrame,
    price: str = "price",
    order: tuple[str, ...] = ("trade_time", "trade_id"),
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Each tick against the one before it: up, down, flat or NULL, and the change.

    The tape of a symbol is handled in blocks of ``block_ms``. A tick without a time comes
    before or after none and is left out.
    """
    block = F.expr(f"{order[0]} div {block_ms}")
    ticks = ticks.where(F.col(order[0]).isNotNull())
    bordered = with_borders(ticks, ["symbol"], list(order), block, back=1)
    before = F.lag(price).over(block_window(["symbol"], list(order)))
    ticked = drop_borrowed(bordered.withColumn("prev_price", before))
    now, prev = F.col(price), F.col("prev_price")
    return ticked.withColumns(
        {
            "direction": F.when(now > prev, "up").when(now < prev, "down").when(now == prev, "flat"),
            "change_pct": F.coalesce(candle.change_pct(now, prev), F.lit(0.0)),
        }
    )


def discover_pairs(
    tickers: DataFrame,
    quote: str = QUOTE_ASSET,
    min_volume: float = MIN_PAIR_VOLUME,
    max_pairs: int = MAX_PAIRS,
) -> DataFrame:
    """Most traded pairs of one quote asset; a volume that does not parse disqualifies."""
    volume = F.col("quote_volume").try_cast("double")
    pairs = tickers.where(quoted_in(F.col("symbol"), quote)).select(
        F.lower("symbol").alias("symbol"), volume.alias("volume")
    )
    return pairs.where(F.col("volume") >= min_volume).orderBy(F.col("volume").desc(), "symbol").limit(max_pairs)


def split_pair(df: DataFrame, quote: str = QUOTE_ASSET) -> DataFrame:
    """Pairs of one quote asset, with base and quote in their own columns."""
    pairs = df.where(quoted_in(F.col("symbol"), quote))
    return pairs.withColumns({"base": base_asset(F.col("symbol"), quote), "quote": F.lit(quote)})


def universe_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """Symbols added to or removed from the tracked set; empty when nothing changed.

    One aggregation over both sides, so a symbol's copies are combined before the
    shuffle.
    """
    sides = old.select("symbol", F.lit(True).alias("_old")).unionByName(
        new.select("symbol", F.lit(False).alias("_old"))
    )
    seen = sides.groupBy("symbol").agg(F.bool_or("_old").alias("was"), F.bool_and("_old").alias("only_was"))
    change: Column = F.when(F.col("only_was"), "removed").when(~F.col("was"), "added")
    return seen.select("symbol", change.alias("change")).where("change IS NOT NULL")
