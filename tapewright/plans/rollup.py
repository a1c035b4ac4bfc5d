"""Scheduled rollup: the candle that closed last, or the whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.candles import cascade, cascade_step, last_closed_bounds
from tapewright.plans.forecast import iso_time
from tapewright.schemas import CASCADE
from tapewright.sources.sinks import CandleTable
from tapewright.sources.tables import scan_candles


def finer(interval: str) -> str:
    return CASCADE[CASCADE.index(interval) - 1]


def roll_last_closed(spark: SparkSession, table: CandleTable, interval: str, as_of: int) -> None:
    """Build one interval's newest closed candles from the next finer ones and store them.

    The scan reads the partitions of that window only. Running it again stores the
    same rows.
    """
    start, end = last_closed_bounds(interval, as_of)
    source = scan_candles(table.read(spark), finer(interval), start=start, end=end)
    made = iso_time(F.lit(as_of).cast("bigint"))
    rolled = cascade_step(source, interval, as_of)
    table.upsert(rolled.withColumns({"created_at": made, "is_closed": F.lit(True)}))  # only windows that have ended


def backfill(candles_1m: DataFrame, interval: str) -> DataFrame:
    """Every candle of ``interval`` from the finest ones."""
    return cascade(candles_1m, interval)
