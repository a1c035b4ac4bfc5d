"""The four streaming queries. Each starts one query with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapewright.functions import candle
from tapewright.operators import candles as bars
from tapewright.operators import ranking as ranks
from tapewright.operators.joins import broadcast_if_small
from tapewright.operators.state import latest_book
from tapewright.schemas import BOOK_TOP, DURATION, LATENESS, TRIGGER
from tapewright.sources.sinks import CandleTable, KeyedTable, append_once, batch_name, replace_table
from tapewright.streaming.supervise import counted

Writer = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame, name: str, mode: str, write: Writer, checkpoint: str, every: str | None
) -> StreamingQuery:
    """Start a query; ``every`` is its cadence, None drains what is there and stops.

    A failing write fails the query, so a checkpoint never moves past lost rows.
    """
    writer = (
        counted(stream)
        .writeStream.queryName(name)
        .outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def tumbling(
    trades: DataFrame, interval: str, dim: DataFrame | None = None, lateness: str = LATENESS["trades"]
) -> DataFrame:
    """Streaming candles on event time: state per (window, symbol) until the watermark.

    The static dimension joins finished aggregates, so its columns stay out of the
    state keys.
    """
    windowed = (
        trades.withColumn("event_ts", candle.event_ts(F.col("trade_time")))
        .withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", DURATION[interval]), "symbol")
        .agg(*bars.trade_aggregates())
    )
    shaped = windowed.withColumns(
        {
            "interval": F.lit(interval),
            "open_time": F.unix_millis("window.start"),
            "close_time": F.unix_millis("window.end"),
            "vwap": candle.vwap(F.col("quote_volume"), F.col("volume")),
        }
    ).select(*bars.BAR_COLUMNS)
    if dim is None:
        return shaped
    return shaped.join(broadcast_if_small(dim.select("symbol", "name", "category")), "symbol", "left")


def start_ohlcv(
    trades: DataFrame,
    interval: str,
    table: CandleTable,
    checkpoint: str,
    dim: DataFrame | None = None,
    every: str | None = TRIGGER["ohlcv"],
    lateness: str = LATENESS["trades"],
) -> StreamingQuery:
    """Candles of one interval, upserted as they change."""
    name = f"ohlcv_{interval}"

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    return run(tumbling(trades, interval, dim, lateness), name, "update", write, checkpoint, every)


def enrich_klines(klines: DataFrame, interval: str = "1m") -> DataFrame:
    """Closed candles of one interval in the stored layout, with geometry."""
    closed = bars.closed_bars(klines, interval).withColumn(
        "vwap", candle.vwap(F.col("quote_volume"), F.col("volume"))
    )
    renamed = closed.withColumn("trades", F.col("trades_count").cast("bigint"))
    return bars.geometry(renamed).select(
        *bars.BAR_COLUMNS,
        "is_closed",
        "price_change_pct",
        "candle_type",
        "body_size",
        "upper_shadow",
        "lower_shadow",
        "event_time",
    )


def start_klines(
    klines: DataFrame,
    table: CandleTable,
    checkpoint: str,
    interval: str = "1m",
    every: str | None = TRIGGER["klines"],
) -> StreamingQuery:
    """Exchange candles, stateless; the newest message of a candle wins, so the table needs an
    order of its messages."""
    if not table.order:
        raise ValueError("exchange candles need a table with an order, such as event_time")

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    return run(enrich_klines(klines, interval), "klines", "append", write, checkpoint, every)


def book_table(path: str) -> KeyedTable:
    """Latest top of book, one row per symbol; ``shard`` is its only partition."""
    layout = T.StructType([*BOOK_TOP.fields, T.StructField("shard", T.IntegerType())])
    return KeyedTable(path, layout, ["symbol", "shard"], ["shard"], ["timestamp"])


def start_book(
    tops: DataFrame,
    latest: KeyedTable,
    history_path: str,
    checkpoint: str,
    every: str | None = TRIGGER["book"],
    shards: int = 16,
) -> StreamingQuery:
    """Top-of-book snapshots to a latest table and a history."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(batch, history_path, "timestamp", batch_name(batch, batch_id))
        shard = F.pmod(F.hash("symbol"), F.lit(shards))
        tops = latest_book(batch).select(*BOOK_TOP.fieldNames()).withColumn("shard", shard)
        latest.upsert(tops)

    return run(tops, "book", "append", write, checkpoint, every)


def session_aggregate(trades: DataFrame) -> DataFrame:
    """Open, close and change per symbol since the stream began.

    State is one row per symbol.
    """
    order = candle.tick_order(F.col("trade_time"), F.col("trade_id"))
    ends = trades.groupBy("symbol").agg(
        F.min_by("price", order).alias("open"),
        F.max_by("price", order).alias("close"),
        F.max("trade_time").alias("last_update"),
    )
    return ends.withColumn("percent_change", candle.change_pct(F.col("close"), F.col("open")))


def start_ranking(
    trades: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER["ranking"]
) -> StreamingQuery:
    """The whole ranking, replaced on every trigger, best first."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_table(batch, path)

    ranked = ranks.ranking(session_aggregate(trades)).orderBy(F.col("percent_change").desc_nulls_last(), "symbol")
    return run(ranked, "ranking", "complete", write, checkpoint, every)


def start_append(stream: DataFrame, name: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """A stateless stream to Parquet files, exactly once through the file sink's log."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        counted(stream)
        .writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**trigger)
        .start()
    )
