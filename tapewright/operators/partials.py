"""Measures of any window from small summaries of every minute, which merge by addition.

A minute's summary is stored once, by a batch or a stream, and folded into windows of any
length that begin on a minute; the events themselves are not read again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions import candle
from tapewright.operators.blocks import block_window, drop_borrowed, with_borders
from tapewright.schemas import WIDTH_MS
from tapewright.sources.sinks import KeyedTable

MINUTE = WIDTH_MS["1m"]

#: Relative error of a quantile from a sketch.
ERROR = 0.01


def windows(minute: Column, width_ms: int, slide_ms: int) -> Column:
    """Starts of all windows of ``width_ms``, one every ``slide_ms``, that hold a minute."""
    if width_ms % slide_ms or slide_ms % MINUTE:
        raise ValueError("a window is a multiple of its slide, and that of a minute")
    newest = candle.bucket_start(minute, slide_ms)
    return F.explode(F.sequence(newest - (width_ms - slide_ms), newest, F.lit(slide_ms).cast("bigint")))


# --- quantiles ---


def ratio(error: float = ERROR) -> float:
    """Quotient of the borders of a bucket, so that its middle is within ``error`` of all of it."""
    return (1 + error) / (1 - error)


def bucketed(value: Column, error: float = ERROR) -> dict[str, Column]:
    """Logarithmic bucket of a value: its sign, and the bucket of its size."""
    size = F.ceil(F.ln(F.abs(value)) / F.lit(math.log(ratio(error)))).cast("int")
    return {"side": F.signum(value).cast("int"), "bucket": F.when(value == 0, 0).otherwise(size)}


def quantile_partials(df: DataFrame, time: str, value: str, keys: list[str] | None = None, error: float = ERROR) -> DataFrame:
    """Counts of every minute by bucket: a few hundred rows, however many events. Events
    without a value or a time are left out."""
    keyed = df.where(F.col(value).isNotNull() & ~F.isnan(value) & F.col(time).isNotNull())
    keyed = keyed.withColumns({"minute": candle.bucket_start(F.col(time), MINUTE), **bucketed(F.col(value), error)})
    return keyed.groupBy("minute", *(keys or []), "side", "bucket").agg(F.count(F.lit(1)).alias("events"))


def quantiles(
    partials: DataFrame, marks: dict[str, float], width_ms: int, slide_ms: int | None = None, keys: list[str] | None = None, error: float = ERROR
) -> DataFrame:
    """Quantiles of sliding windows from the partials of their minutes.

    Each is within ``error`` of the exact value at its rank. Sketches merge by adding counts,
    partially before the shuffle; the running sum has a row for each bucket of a window.
    """
    keys = keys or []
    spread = partials.withColumn("window_start", windows(F.col("minute"), width_ms, slide_ms or width_ms))
    merged = spread.groupBy("window_start", *keys, "side", "bucket").agg(F.sum("events").alias("events"))
    place = F.col("side") * F.col("bucket")
    along = Window.partitionBy("window_start", *keys).orderBy("side", place)
    merged = merged.withColumns(
        {
            "rank": F.sum("events").over(along.rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("events").over(Window.partitionBy("window_start", *keys)),
            "middle": F.col("side") * 2 * F.pow(F.lit(ratio(error)), F.col("bucket")) / F.lit(ratio(error) + 1),
        }
    )
    found = [F.min(F.when(F.col("rank") >= q * F.col("total"), F.struct("side", place.alias("place"), "middle")))["middle"].alias(n) for n, q in marks.items()]
    return merged.groupBy("window_start", *keys).agg(F.max("total").alias("events"), *found)


def quantile_table(path: str) -> KeyedTable:
    """Stored partials of every minute, by day."""
    fields = T.StructType.fromDDL("minute bigint, side int, bucket int, events bigint, date string")
    return KeyedTable(path, fields, ["minute", "side", "bucket"], ["date"], ["events"])


# --- counts and shares ---


def count_partials(df: DataFrame, time: str, is_error: str, keys: list[str] | None = None) -> DataFrame:
    """Events and failed events of every minute."""
    minute = candle.bucket_start(F.col(time), MINUTE).alias("minute")
    return df.where(F.col(time).isNotNull()).groupBy(minute, *(keys or [])).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col(is_error)).alias("errors")
    )


def error_ratio(partials: DataFrame, width_ms: int, slide_ms: int, keys: list[str] | None = None) -> DataFrame:
    """Events per second and the share of failed ones in percent, of sliding windows."""
    spread = partials.withColumn("window_start", windows(F.col("minute"), width_ms, slide_ms))
    summed = spread.groupBy("window_start", *(keys or [])).agg(F.sum("events").alias("events"), F.sum("errors").alias("errors"))
    return summed.withColumns(
        {"per_second": F.col("events") / F.lit(width_ms / 1000.0), "error_pct": F.col("errors") * 100.0 / F.col("events")}
    )


# --- counters ---


def _step(value: Column, before: Column) -> Column:
    """What a counter has grown by; one that fell began anew at 0."""
    return F.when(value >= before, value - before).otherwise(value)


def counter_partials(samples: DataFrame, keys: list[str], time: str, value: str, order: str | None = None) -> DataFrame:
    """First and last sample of every minute of a counter, and its growth between them.

    ``order`` parts samples of one millisecond. A group is one minute of one counter.
    """
    last = F.col(order) if order else F.col(value)
    rows = samples.where(F.col(time).isNotNull() & F.col(value).isNotNull())
    rows = rows.select(*keys, candle.bucket_start(F.col(time), MINUTE).alias("minute"), F.struct(F.col(time).alias("t"), last.alias("o")).alias("at"), F.col(value).alias("v"))
    before = F.lag("v").over(Window.partitionBy(*keys, "minute").orderBy("at"))
    return rows.withColumn("grown", F.when(before.isNotNull(), _step(F.col("v"), before))).groupBy(*keys, "minute").agg(
        F.min_by("v", "at").alias("first"), F.max_by("v", "at").alias("last"), F.coalesce(F.sum("grown"), F.lit(0)).alias("increase"), F.count(F.lit(1)).alias("samples")
    )


def counter_rate(partials: DataFrame, keys: list[str], width_ms: int, slide_ms: int, block_ms: int = WIDTH_MS["1d"]) -> DataFrame:
    """Growth of counters over sliding windows, restarts included, and its rate per second.

    A minute follows the one before it that has samples; that step counts in windows that
    hold both. A counter's minutes are cut into blocks of time, each with a copy of the minute
    before it, so no task holds a counter's whole history.
    """
    bordered = with_borders(partials, keys, ["minute"], F.expr(f"minute div {block_ms}"), back=1)
    along = block_window(keys, ["minute"])
    linked = drop_borrowed(bordered.withColumns({"last_before": F.lag("last").over(along), "minute_before": F.lag("minute").over(along)}))
    linked = linked.withColumn("step", _step(F.col("first"), F.col("last_before")))
    spread = linked.withColumn("window_start", windows(F.col("minute"), width_ms, slide_ms))
    step = F.when(F.col("minute_before") >= F.col("window_start"), F.col("step")).otherwise(0)
    summed = spread.groupBy(*keys, "window_start").agg(F.sum(F.col("increase") + step).alias("increase"), F.sum("samples").alias("samples"))
    return summed.withColumn("per_second", F.col("increase") / F.lit(width_ms / 1000.0))
