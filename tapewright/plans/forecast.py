"""Scoring: features of recent candles through the stored linear model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions import scoring
from tapewright.operators.features import clean, features, latest_k, latest_row
from tapewright.operators.serving import fallback_source
from tapewright.schemas import LOOKBACK_BARS, PREDICTION, WIDTH_MS
from tapewright.session import materialize
from tapewright.sources.sinks import KeyedTable
from tapewright.sources.tables import day_of, scan_recent, time_range

PREDICTION_COLUMNS = PREDICTION.fieldNames()


def iso_time(time_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(time_ms), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def score(rows: DataFrame, params: Mapping) -> DataFrame:
    return rows.withColumn("prediction", scoring.linear_score(params))


def predictions(rows: DataFrame, params: Mapping, prediction_time: Column, interval: str = "5m") -> DataFrame:
    """Forecast per feature row: change, price, direction (DOWN at exactly zero), times."""
    change = F.col("prediction")
    closes_at = F.expr(f"(open_time + {WIDTH_MS[interval]}) div 1000")
    return (
        score(rows, params)
        .withColumns(
            {
                "predicted_change_pct": change,
                "predicted_price": F.col("close") * (1 + change / 100),
                "direction": F.when(change > 0, "UP").otherwise("DOWN"),
                "prediction_time": prediction_time,
                "target_time": F.from_unixtime(closes_at),
            }
        )
        .select(*PREDICTION_COLUMNS)
    )


def recent_or_latest(
    candles: DataFrame, as_of: int, interval: str = "5m", periods: int = LOOKBACK_BARS, per_symbol: bool = False
) -> DataFrame:
    """Recent candles, or the newest ``periods`` per symbol where those are too few; closed at
    ``as_of`` in either case.

    The threshold counts rows of all symbols together. ``per_symbol`` always takes the
    newest ``periods`` of each symbol instead.
    """
    one = time_range(candles.where(F.col("interval") == interval), end=as_of - WIDTH_MS[interval], interval=interval)
    older = latest_k(one, max(periods, LOOKBACK_BARS))
    if per_symbol:
        return older
    return fallback_source(scan_recent(candles, as_of, interval, periods), older, periods)


def forecast(candles: DataFrame, params: Mapping, as_of: int, interval: str = "5m") -> DataFrame:
    """One prediction per symbol from its newest complete feature row."""
    source = recent_or_latest(candles, as_of, interval)
    # At most a few dozen candles per symbol, so each symbol is handled in one piece.
    newest = latest_row(features(source, interval, block_bars=None))
    return predictions(clean(newest, None), params, iso_time(F.lit(as_of).cast("bigint")), interval)


class PredictionStore:
    """Every prediction ever made, by day, and the latest of each symbol.

    ``made_at`` is the clock of the run. A run repeated for one clock adds nothing, and one
    for an earlier clock does not replace a later prediction.
    """

    def __init__(self, path: str, shards: int = 16):
        self.shards = shards
        fields = [*PREDICTION.fields, T.StructField("made_at", T.LongType())]
        history = T.StructType([*fields, T.StructField("date", T.StringType())])
        latest = T.StructType([*fields, T.StructField("shard", T.IntegerType())])
        self.history = KeyedTable(f"{path}/history", history, ["symbol", "made_at"], ["date"])
        self.latest = KeyedTable(f"{path}/latest", latest, ["symbol"], ["shard"], ["made_at"])

    def add(self, predictions: DataFrame, as_of: int) -> None:
        made = predictions.withColumn("made_at", F.lit(as_of).cast("bigint"))
        self.history.upsert(made.withColumn("date", day_of(F.col("made_at"))))
        self.latest.upsert(made.withColumn("shard", F.pmod(F.hash("symbol"), F.lit(self.shards))))


def run_forecast(candles: DataFrame, params: Mapping, as_of: int, store: PredictionStore, interval: str = "5m") -> None:
    """One scheduled run: forecast at the clock and keep the predictions."""
    store.add(materialize(forecast(candles, params, as_of, interval), "forecast"), as_of)
