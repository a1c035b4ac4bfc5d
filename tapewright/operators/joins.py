"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import candle
from tapewright.schemas import WIDTH_MS

#: Most rows and most bytes (as JSON text) a side may have to be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast hint behind a size check that looks at ``max_rows + 1`` rows at most.

    A larger side is left to the optimizer: a shuffled join whose hot keys adaptive
    execution splits.
    """
    width = F.octet_length(F.to_json(F.struct(*side.columns)))
    rows, size = side.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).collect()[0]
    return F.broadcast(side) if rows <= max_rows and size <= max_bytes else side


def join_dim(facts: DataFrame, dim: DataFrame, key: str = "symbol") -> DataFrame:
    """Left join to a dimension; facts without a match are kept."""
    return facts.join(broadcast_if_small(dim), key, "left")


def active_symbols(candles: DataFrame, source: DataFrame) -> DataFrame:
    """Candles of symbols that occur in ``source``."""
    return candles.join(source.select("symbol").distinct(), "symbol", "left_semi")


def lookup_hot_cold(symbols: DataFrame, hot: DataFrame, cold: DataFrame) -> DataFrame:
    """Per requested symbol the hot row if there is one, else the cold row, else none.

    Both sides hold one row per symbol. Rows are taken whole, never mixed by column.
    """
    tagged = hot.withColumn("tier", F.lit("hot")).unionByName(cold.withColumn("tier", F.lit("cold")))
    wanted = tagged.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    others = [c for c in wanted.columns if c not in ("symbol", "tier")]
    best = wanted.groupBy("symbol").agg(
        F.max_by(F.struct("tier", *others), F.col("tier") == "hot").alias("row")
    )
    return best.select("symbol", "row.*")


def with_actuals(predictions: DataFrame, candles: DataFrame, interval: str = "5m") -> DataFrame:
    """Predictions with the realised close of the bar they forecast.

    Keyed by symbol and exact bar time, so no key is hot. ``accuracy`` is 100 minus
    the price error in percent, not below 0; all three columns are NULL while the bar
    is missing.
    """
    actual = candles.select(
        "symbol",
        (F.col("open_time") - WIDTH_MS[interval]).alias("open_time"),
        F.col("close").alias("actual_price"),
    )
    return realised(predictions.join(actual, ["symbol", "open_time"], "left"))


def realised(joined: DataFrame) -> DataFrame:
    """Realised change and accuracy of predictions that have their ``actual_price``."""
    error = F.abs(candle.change_pct(F.col("predicted_price"), F.col("actual_price")))
    return joined.withColumns(
        {
            "actual_change": candle.change_pct(F.col("actual_price"), F.col("close")),
            "accuracy": F.when(error.isNotNull(), F.greatest(100 - error, F.lit(0.0))),
        }
    )
