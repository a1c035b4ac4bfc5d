"""Reads of stored tables. Filters are plain comparisons on stored columns, so they
prune ``interval``/``date`` partitions and reach the Parquet scan."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.schemas import (
    LOOKBACK_BARS,
    MODEL_PARAMS,
    PARTITION_SPAN,
    SYMBOL_METADATA,
    SYMBOLS,
    TRAINING_DAYS,
    WIDTH_MS,
)

DAY_MS = 86_400_000


def day_of(time_ms: Column) -> Column:
    """Partition value of an event time."""
    return F.date_format(F.timestamp_millis(time_ms), "yyyy-MM-dd")


def partition_date(interval: Column, time_ms: Column) -> Column:
    """Partition value of a candle: first day of the span its interval is stored in."""
    start = F.timestamp_millis(time_ms)
    span = F.lit("day")
    for name, value in PARTITION_SPAN.items():
        span = F.when(interval == name, value).otherwise(span)
    trimmed = F.when(span == "year", F.trunc(start, "year")).when(span == "month", F.trunc(start, "month"))
    return F.date_format(trimmed.otherwise(start.cast("date")), "yyyy-MM-dd")


def first_day(interval: str | None, time_ms: int) -> str:
    """``partition_date`` of a known time; without an interval the earliest it can be."""
    day = datetime.fromtimestamp(time_ms // 1000, tz=timezone.utc).date()
    span = PARTITION_SPAN[interval] if interval else "year"
    if span != "day":
        day = day.replace(day=1)
    if span == "year":
        day = day.replace(month=1)
    return day.isoformat()


def time_range(
    df: DataFrame,
    start: int | None = None,
    end: int | None = None,
    column: str = "open_time",
    closed: bool = True,
    interval: str | None = None,
) -> DataFrame:
    """Rows in ``[start, end]`` (or ``[start, end)``), either bound optional.

    Also bounds the ``date`` partition when the table has one; naming the interval makes
    that bound tight.
    """
    dated = "date" in df.columns
    if start is not None:
        df = df.where(F.col(column) >= start)
        if dated:
            df = df.where(F.col("date") >= first_day(interval, start))
    if end is not None:
        df = df.where(F.col(column) <= end if closed else F.col(column) < end)
        if dated:
            df = df.where(F.col("date") <= first_day("1m", end))
    return df


def scan_candles(
    candles: DataFrame,
    interval: str,
    symbols: list[str] | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Candles of one interval in the half-open range ``[start, end)``."""
    df = candles.where(F.col("interval") == interval)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(symbols))
    return time_range(df, start, end, closed=False, interval=interval)


def scan_training_window(
    candles: DataFrame, as_of: int, interval: str = "5m", days: int = TRAINING_DAYS, symbols: list[str] | None = None
) -> DataFrame:
    """Candles of the last ``days`` days, both ends included."""
    df = candles.where(F.col("interval") == interval)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(symbols))
    return time_range(df, as_of - days * DAY_MS, as_of, interval=interval)


def scan_recent(
    candles: DataFrame,
    as_of: int,
    interval: str = "5m",
    periods: int = LOOKBACK_BARS,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Candles closed at ``as_of`` and no older than ``periods`` candle widths. A candle that is
    still open, or opens later, holds trades the clock has not seen."""
    df = candles.where(F.col("interval") == interval)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(symbols))
    width = WIDTH_MS[interval]
    return time_range(df, as_of - periods * width, as_of - width, interval=interval)


def symbol_metadata(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The symbol dimension, one row per symbol, as literals in the plan."""
    names = SYMBOL_METADATA.fieldNames()
    records = [
        F.struct(*(F.lit(value).alias(name) for name, value in zip(names, row, strict=True)))
        for row in (SYMBOLS if rows is None else rows)
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))


def read_model_params(spark: SparkSession, path: str) -> DataFrame:
    """Stored model parameters, one row per model."""
    return spark.read.schema(MODEL_PARAMS).option("multiLine", True).json(path)


def coefficient_table(params: DataFrame) -> DataFrame:
    """One row per feature: mean, deviation and weight, with their defaults."""
    name = F.col("feature")
    return params.select("*", F.explode("features").alias("feature")).select(
        "feature",
        F.coalesce(F.try_element_at("scaler_mean", name), F.lit(0.0)).alias("mean"),
        F.coalesce(F.try_element_at("scaler_std", name), F.lit(1.0)).alias("std"),
        F.coalesce(F.try_element_at("coefficients", name), F.lit(0.0)).alias("coefficient"),
        "intercept",
    )


def params_dict(params: DataFrame) -> dict:
    """The single parameter row as a dictionary, for folding into a score expression."""
    return params.limit(1).collect()[0].asDict(recursive=True)
