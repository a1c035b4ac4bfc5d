"""The range, page and latest queries a dashboard asks. Each limit is the page size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.sources.tables import time_range


def _of(candles: DataFrame, symbol: str, interval: str) -> DataFrame:
    return candles.where((F.col("symbol") == symbol) & (F.col("interval") == interval))


def _newest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.col("open_time").desc()).limit(n)


def closed_flag(columns: list[str], as_of: int | None = None) -> Column:
    """Closed marker under either of its names; where neither is set, whether the candle
    has ended at ``as_of``, or false without a clock."""
    present = [F.col(c) for c in ("is_closed", "x") if c in columns]
    ended = F.lit(False) if as_of is None else F.col("close_time") <= as_of
    return F.coalesce(*present, ended)


def candles_latest(
    candles: DataFrame, symbol: str, interval: str = "5m", n: int = 200, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Newest ``n`` candles within optional inclusive bounds, oldest first."""
    return _newest(time_range(_of(candles, symbol, interval), start, end, interval=interval), n).orderBy("open_time")


def candles_page_before(
    candles: DataFrame, symbol: str, start: int, interval: str = "1m", n: int = 200, as_of: int | None = None
) -> DataFrame:
    """Newest ``n`` candles strictly before ``start``; of these the closed ones, oldest first."""
    page = _newest(time_range(_of(candles, symbol, interval), end=start, closed=False, interval=interval), n)
    return page.where(closed_flag(candles.columns, as_of)).orderBy("open_time")


def candles_page_until(
    candles: DataFrame, symbol: str, end: int, interval: str = "1m", n: int = 200, as_of: int | None = None
) -> DataFrame:
    """First ``n`` candles up to ``end``; of these the closed ones, oldest first."""
    page = time_range(_of(candles, symbol, interval), end=end, interval=interval).orderBy("open_time").limit(n)
    return page.where(closed_flag(candles.columns, as_of)).orderBy("open_time")


def candles_closed(
    candles: DataFrame, symbol: str, interval: str = "1m", n: int = 100, as_of: int | None = None
) -> DataFrame:
    """Newest ``n`` candles, then only the closed ones, oldest first."""
    return _newest(_of(candles, symbol, interval), n).where(closed_flag(candles.columns, as_of)).orderBy("open_time")


def trades_latest(trades: DataFrame, symbol: str, n: int = 50) -> DataFrame:
    """Newest ``n`` trades, newest first."""
    mine = trades.where(F.col("symbol") == symbol)
    return mine.orderBy(F.col("trade_time").desc(), F.col("trade_id").desc()).limit(n)


def prediction_history(predictions: DataFrame, symbol: str, n: int = 50) -> DataFrame:
    """Newest ``n`` predictions of a symbol."""
    return predictions.where(F.col("symbol") == symbol).orderBy(F.col("prediction_time").desc(), F.col("open_time").desc()).limit(n)


def predictions_by_change(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy(F.col("predicted_change_pct").desc(), "symbol")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key; every map task keeps one row of each key before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def sample_predictions(scored: DataFrame, n: int = 10) -> DataFrame:
    """A few rows of actual against predicted change, in a fixed order."""
    return scored.select("symbol", "open_time", "close", "target", "prediction").orderBy("open_time", "symbol").limit(n)


def fallback_source(recent: DataFrame, older: DataFrame, min_rows: int) -> DataFrame:
    """``recent`` if it has at least ``min_rows`` rows in total, else ``older`` instead.

    The check reads no more than ``min_rows`` rows.
    """
    return recent if recent.limit(min_rows).count() >= min_rows else older


def enough_rows(df: DataFrame, min_rows: int) -> bool:
    """Whether ``df`` has at least ``min_rows`` rows."""
    return df.limit(min_rows).count() >= min_rows
