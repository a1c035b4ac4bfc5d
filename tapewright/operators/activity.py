"""Counts, statistics and operational measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import candle
from tapewright.operators.ranking import first_last


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def count_rows_and_symbols(df: DataFrame) -> DataFrame:
    """Row and symbol count from one pass: counts per symbol, then their sum."""
    per_symbol = df.groupBy("symbol").agg(F.count("*").alias("n"))
    return per_symbol.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("symbol").alias("symbols")
    )


def basic_stats(df: DataFrame, price: str = "price", volume: str = "volume") -> DataFrame:
    return df.groupBy("symbol").agg(
        F.sum(volume).alias("total_volume"),
        F.avg(price).alias("avg_price"),
        F.max(price).alias("max_price"),
        F.min(price).alias("min_price"),
    )


def trade_flow(trades: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Bought and sold quantity and the buy share in percent; 50 without volume."""
    sold = F.col("is_buyer_maker")
    sums = trades.groupBy(*keys).agg(
        F.sum(F.when(~sold, F.col("quantity")).otherwise(0.0)).alias("buy_quantity"),
        F.sum(F.when(sold, F.col("quantity")).otherwise(0.0)).alias("sell_quantity"),
    )
    total = F.col("buy_quantity") + F.col("sell_quantity")
    share = F.when(total > 0, F.try_divide(F.col("buy_quantity"), total) * 100).otherwise(50.0)
    return sums.withColumn("buy_pct", share)


def pair_stats(klines: DataFrame, trades: DataFrame, interval: str = "1m") -> DataFrame:
    """Messages and last price per symbol over candle updates and trades together."""
    bars = klines.where(F.col("interval") == interval).select(
        "symbol",
        F.col("event_time").alias("time"),
        F.lit(0).cast("bigint").alias("trade_id"),
        F.col("close").alias("price"),
    )
    ticks = trades.select("symbol", F.col("trade_time").alias("time"), "trade_id", "price")
    ends = first_last(bars.unionByName(ticks), ["symbol"], time="time")
    return ends.select("symbol", F.col("rows").alias("messages"), F.col("last").alias("last_price"))


def pair_report(stats: DataFrame) -> DataFrame:
    """``pair_stats`` with one more row, symbol ``TOTAL``, over all symbols."""
    is_total = F.grouping("symbol") == 1
    summed = stats.rollup("symbol").agg(
        is_total.alias("_total"), F.sum("messages").alias("messages"), F.max("last_price").alias("last_price")
    )
    return summed.select(
        F.when(F.col("_total"), F.lit("TOTAL")).otherwise(F.col("symbol")).alias("symbol"),
        "messages",
        F.when(~F.col("_total"), F.col("last_price")).alias("last_price"),
    )


def throughput(df: DataFrame, time: str, keys: list[str], width_ms: int = 60_000) -> DataFrame:
    """Events per second by key in fixed windows."""
    start = candle.bucket_start(F.col(time), width_ms).alias("window_start")
    counted = df.groupBy(start, *keys).agg(F.count("*").alias("events"))
    return counted.withColumn("per_second", F.col("events") / F.lit(width_ms / 1000.0))


def error_ratio(df: DataFrame, time: str, is_error: str, width_ms: int = 300_000) -> DataFrame:
    """Share of failed events per window in percent."""
    start = candle.bucket_start(F.col(time), width_ms).alias("window_start")
    counted = df.groupBy(start).agg(
        F.count("*").alias("events"), F.count_if(F.col(is_error)).alias("errors")
    )
    return counted.withColumn("error_pct", F.col("errors") * 100.0 / F.col("events"))


def latency_quantiles(
    df: DataFrame, time: str, duration: str, width_ms: int = 300_000, accuracy: int = 10_000
) -> DataFrame:
    """50th, 95th and 99th percentile per window from a mergeable, bounded summary.

    Exact while a window has fewer than ``accuracy`` rows, within 1/``accuracy`` of
    the rank beyond that.
    """
    start = candle.bucket_start(F.col(time), width_ms).alias("window_start")
    marks = F.percentile_approx(duration, [0.5, 0.95, 0.99], accuracy)
    return (
        df.groupBy(start)
        .agg(F.count("*").alias("events"), marks.alias("_q"))
        .select(
            "window_start", "events", F.col("_q")[0].alias("p50"), F.col("_q")[1].alias("p95"), F.col("_q")[2].alias("p99")
        )
    )


def regression_metrics(scored: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 in one pass. R2 is NULL for a constant label."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    sums = scored.agg(
        F.count("*").alias("n"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("var"),
    )
    return sums.select(
        "n",
        F.sqrt(F.try_divide("sse", "n")).alias("rmse"),
        "mae",
        (1 - F.try_divide(F.col("sse"), F.col("var") * F.col("n"))).alias("r2"),
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Forecast directions with their shares, and the mean and extreme change."""
    change, total = F.col("predicted_change_pct"), F.col("total")
    counts = predictions.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("direction") == "UP").alias("up_count"),
        F.avg(change).alias("avg_change"),
        F.max(change).alias("max_change"),
        F.min(change).alias("min_change"),
    )
    down = total - F.col("up_count")
    return counts.withColumns(
        {
            "down_count": down,
            "up_pct": F.try_divide(F.col("up_count") * 100.0, total),
            "down_pct": F.try_divide(down * 100.0, total),
        }
    )
