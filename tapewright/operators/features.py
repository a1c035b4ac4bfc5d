"""Technical-indicator features of candles. Lags, frames and the label count rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapewright.functions import candle
from tapewright.operators.blocks import block_window, drop_borrowed, with_borders
from tapewright.operators.candles import signed_geometry
from tapewright.schemas import FEATURES, LOOKBACK_BARS, WIDTH_MS

#: Rows a feature reaches back (20-row average) and the label reaches ahead.
BACK, AHEAD = 19, 1

#: Candle widths per time block. 4096 five-minute bars are two weeks.
BLOCK_BARS = 4096

INPUT = ["symbol", "open_time", "open", "high", "low", "close", "volume"]


def _mean(column: str, rows: int, along: WindowSpec) -> Column:
    return F.avg(column).over(along.rowsBetween(1 - rows, 0))


def _deviation(column: str, rows: int, along: WindowSpec) -> Column:
    return F.stddev_samp(column).over(along.rowsBetween(1 - rows, 0))


def lags(along: WindowSpec) -> dict[str, Column]:
    return {f"close_lag{k}": F.lag("close", k).over(along) for k in (1, 2, 3)}


def returns(_: WindowSpec | None = None) -> dict[str, Column]:
    """Percent change from one and two rows back; 0 without that history."""
    close = F.col("close")
    return {
        f"return_{k}": F.when(
            F.col(f"close_lag{k}").isNotNull(), candle.change_pct(close, F.col(f"close_lag{k}"))
        ).otherwise(0.0)
        for k in (1, 2)
    }


def moving_averages(along: WindowSpec) -> dict[str, Column]:
    return {f"ma{n}": _mean("close", n, along) for n in (5, 10, 20)}


def volatility(along: WindowSpec) -> dict[str, Column]:
    """Sample deviation of the close; NULL on a symbol's first row."""
    return {f"volatility_{n}": _deviation("close", n, along) for n in (5, 10)}


def volume_average(along: WindowSpec) -> dict[str, Column]:
    return {"volume_ma5": _mean("volume", 5, along)}


def volume_ratio() -> dict[str, Column]:
    average = F.col("volume_ma5")
    return {"volume_ratio": F.when(average > 0, F.try_divide(F.col("volume"), average)).otherwise(1.0)}


def price_to_average() -> dict[str, Column]:
    """Distance of the close from its averages in percent."""
    return {
        f"price_to_ma{n}": F.when(F.col(f"ma{n}") > 0, candle.change_pct(F.col("close"), F.col(f"ma{n}"))).otherwise(
            0.0
        )
        for n in (5, 20)
    }


def gains_and_losses(along: WindowSpec) -> dict[str, Column]:
    """Plain 14-row means of the positive and the negative part of ``return_1``."""
    frame = along.rowsBetween(-13, 0)
    change = F.col("return_1")
    return {
        "avg_gain": F.avg(F.when(change > 0, change).otherwise(0.0)).over(frame),
        "avg_loss": F.avg(F.when(change < 0, -change).otherwise(0.0)).over(frame),
    }


def rsi() -> dict[str, Column]:
    """Relative strength: 100 with gains only, 50 when nothing moved."""
    gain, loss = F.col("avg_gain"), F.col("avg_loss")
    strength = 100 - 100 / (1 + F.try_divide(gain, loss))
    return {"rsi": F.when(loss > 0, strength).when(gain > 0, 100.0).otherwise(50.0)}


def label(along: WindowSpec) -> dict[str, Column]:
    """Close of the next row and the change to it in percent."""
    ahead = F.lead("close", 1).over(along)
    return {"next_close": ahead, "target": candle.change_pct(ahead, F.col("close"))}


def add_features(candles: DataFrame, along: WindowSpec) -> DataFrame:
    """All feature and label columns over a given window: one exchange and one sort."""
    return (
        signed_geometry(candles)
        .withColumns({**lags(along), **moving_averages(along), **volatility(along), **volume_average(along), **label(along)})
        .withColumns({**returns(), **volume_ratio(), **price_to_average()})
        .withColumns(gains_and_losses(along))
        .withColumns(rsi())
    )


def features(candles: DataFrame, interval: str = "5m", block_bars: int | None = BLOCK_BARS) -> DataFrame:
    """Features and label of every candle.

    A symbol's history is cut into blocks of ``block_bars`` candle widths; ``None``
    handles each symbol in one task.
    """
    bars = candles.select(*INPUT)
    if block_bars is None:
        return add_features(bars, Window.partitionBy("symbol").orderBy("open_time"))
    block = F.expr(f"open_time div {WIDTH_MS[interval] * block_bars}")
    bordered = with_borders(bars, ["symbol"], ["open_time"], block, BACK, AHEAD)
    return drop_borrowed(add_features(bordered, block_window(["symbol"], ["open_time"])))


def clean(df: DataFrame, label_column: str | None = "target") -> DataFrame:
    """Rows with every model input, and the label when training."""
    needed = [*FEATURES, *([label_column] if label_column else [])]
    return df.dropna(subset=needed)


def latest_k(candles: DataFrame, k: int = LOOKBACK_BARS) -> DataFrame:
    """Newest ``k`` candles per symbol; every map task keeps at most ``k`` of each."""
    newest = Window.partitionBy("symbol").orderBy(F.col("open_time").desc())
    return candles.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k).drop("_rank")


def latest_row(df: DataFrame, order: str = "open_time") -> DataFrame:
    """Newest row per symbol."""
    newest = Window.partitionBy("symbol").orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
