"""Latest-value tables, retention and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.functions import scoring
from tapewright.operators.serving import latest_per_key
from tapewright.schemas import RECENT_TRADES


def latest_candle(klines: DataFrame) -> DataFrame:
    """Newest message per symbol and interval."""
    return latest_per_key(klines, ["symbol", "interval"], ["open_time", "event_time"])


def ticker(candles: DataFrame, interval: str = "1m") -> DataFrame:
    """Last price per symbol, with the volume and time of its candle.

    All three columns follow the same BIGINT order key, so this is one hash aggregate.
    """
    return (
        candles.where(F.col("interval") == interval)
        .groupBy("symbol")
        .agg(
            F.max_by("close", "open_time").alias("price"),
            F.max_by("volume", "open_time").alias("bar_volume"),
            F.max("open_time").alias("updated_at"),
        )
    )


def latest_book(books: DataFrame) -> DataFrame:
    """Newest snapshot per symbol."""
    return latest_per_key(books, ["symbol"], ["timestamp", *(c for c in ("best_bid", "best_ask") if c in books.columns)])


def recent_trades(trades: DataFrame, keep: int = RECENT_TRADES, salts: int = 64) -> DataFrame:
    """Newest ``keep`` different trades per symbol; identical messages count once.

    Dense ranking gives identical messages one rank, so each map task passes on at
    most ``keep`` different trades per symbol. Copies are first ranked per (symbol,
    scan task), which spreads a trade with very many copies over ``salts`` groups, and
    collapsed there; the final ranking sees ``salts * keep`` rows per symbol at most.
    """
    identity = [F.col("trade_time").desc(), F.col("trade_id").desc()]
    rest = [F.col(c).desc() for c in trades.columns if c not in ("symbol", "trade_time", "trade_id")]
    spread = trades.withColumn("_salt", F.spark_partition_id() % salts)
    local = F.dense_rank().over(Window.partitionBy("symbol", "_salt").orderBy(*identity, *rest))
    collapsed = spread.withColumn("_r", local).where(F.col("_r") <= keep).drop("_r", "_salt").distinct()
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(*identity, *rest))
    return collapsed.withColumn("_r", newest).where(F.col("_r") <= keep).drop("_r")


def latest_prediction(predictions: DataFrame) -> DataFrame:
    """Newest prediction per symbol in the served layout; no direction is ``UNKNOWN``."""
    newest = latest_per_key(predictions, ["symbol"], ["prediction_time", "open_time"])
    change = F.col("predicted_change_pct")
    return newest.select(
        "symbol",
        F.col("close").alias("current_price"),
        "predicted_price",
        change.alias("predicted_change"),
        F.coalesce("direction", F.lit("UNKNOWN")).alias("direction"),
        "prediction_time",
        "target_time",
        scoring.confidence(change).alias("confidence_score"),
    )


def retain(df: DataFrame, ttl_seconds: int, as_of: int, column: str | Column = "open_time") -> DataFrame:
    """Rows younger than their time to live."""
    stamp = F.col(column) if isinstance(column, str) else column
    return df.where(stamp > as_of - ttl_seconds * 1000)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty for a sound table."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key: {bad[0].asDict()}")
