"""Streaming queries, run over all messages until none are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapewright.operators.candles import BAR_COLUMNS
from tapewright.schemas import BOOK_TOP, KLINE, TRADE
from tapewright.sources.decode import decode_json
from tapewright.sources.sinks import CandleTable, read_latest
from tapewright.sources.streams import read_files
from tapewright.streaming import jobs
from tapewright.streaming.supervise import ProgressLog, await_all
from tapewright.suite.inputs import FIRST_DAY, Inputs
from tapewright.suite.registry import query

SUMS = "quote_volume vwap"
GEOMETRY = ["price_change_pct", "candle_type", "body_size", "upper_shadow", "lower_shadow"]


def json_stream(i: Inputs, rows: DataFrame, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """``rows`` as JSON messages read back as a typed stream."""
    text = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    path = i.as_files(text, "messages")
    return decode_json(read_files(i.stream_spark, path, max_files=max_files), schema)


def drained(i: Inputs, stream: DataFrame, name: str) -> DataFrame:
    """Rows a stateless stream appends to Parquet files."""
    path = i.scratch(name)
    await_all([jobs.start_append(stream, name, path, i.scratch("checkpoint"))])
    return i.spark.read.parquet(path)


def stored_candles(i: Inputs, table: CandleTable, queries: list[StreamingQuery], *more: str) -> DataFrame:
    await_all(queries)
    return table.read(i.spark).select(*BAR_COLUMNS, *more)


@query(
    "src_trades_stream",
    """SELECT symbol, trade_id, price, quantity, trade_time, is_buyer_maker, true AS is_best_match,
  trade_time AS event_time, trade_time AS ingestion_time FROM tape""",
)
def _trades(i: Inputs) -> DataFrame:
    return drained(i, json_stream(i, i.trades, TRADE), "trades")


@query("src_klines_stream", "SELECT * FROM klines_1h", "quote_volume")
def _klines(i: Inputs) -> DataFrame:
    return drained(i, json_stream(i, i.klines("1h"), KLINE), "klines")


@query("src_book_stream", "SELECT symbol, best_bid, best_ask, spread, timestamp FROM tops", "spread")
def _books(i: Inputs) -> DataFrame:
    tops = i.books.select(*BOOK_TOP.fieldNames())
    return drained(i, json_stream(i, tops, BOOK_TOP), "books")


@query("stream_ohlcv_tumbling", "SELECT * FROM bars_1h", SUMS)
def _tumbling(i: Inputs) -> DataFrame:
    table = CandleTable(i.scratch("candles"))
    stream = json_stream(i, i.trades, TRADE)
    return stored_candles(i, table, [jobs.start_ohlcv(stream, "1h", table, i.scratch("checkpoint"), every=None)])


@query("stream_dim_join", "SELECT b.*, name, category FROM bars_4h b LEFT JOIN dim USING (symbol)", SUMS)
def _dim(i: Inputs) -> DataFrame:
    table = CandleTable(i.scratch("candles"))
    stream = json_stream(i, i.trades, TRADE)
    query_ = jobs.start_ohlcv(stream, "4h", table, i.scratch("checkpoint"), _stream_dim(i), None)
    return stored_candles(i, table, [query_], "name", "category")


def _stream_dim(i: Inputs) -> DataFrame:
    from tapewright.sources.tables import symbol_metadata
    from tapewright.suite.inputs import DIM_ROWS

    return symbol_metadata(i.stream_spark, DIM_ROWS)


@query(
    "stream_kline_enrich",
    """SELECT symbol, interval, open_time, close_time, open, high, low, close, volume, quote_volume,
  CAST(trades_count AS BIGINT) AS trades, taker_buy_volume, quote_volume / nullif(volume, 0) AS vwap, is_closed, event_time,
  (close - open) / nullif(open, 0) * 100 AS price_change_pct,
  CASE WHEN close >= open THEN 'bullish' ELSE 'bearish' END AS candle_type, abs(close - open) AS body_size,
  high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow
FROM klines_1m WHERE is_closed""",
    f"{SUMS} price_change_pct body_size upper_shadow lower_shadow",
)
def _enrich(i: Inputs) -> DataFrame:
    table = CandleTable(i.scratch("candles"), ["event_time"])
    stream = json_stream(i, i.klines(), KLINE)
    running = jobs.start_klines(stream, table, i.scratch("checkpoint"), every=None)
    return stored_candles(i, table, [running], *GEOMETRY, "is_closed", "event_time")


@query(
    "stream_book",
    """SELECT *, 'history' AS kind FROM (SELECT symbol, best_bid, best_ask, spread, timestamp FROM tops)
UNION ALL SELECT *, 'latest' FROM (SELECT symbol, best_bid, best_ask, spread, timestamp FROM tops
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1)""",
    "spread",
)
def _book(i: Inputs) -> DataFrame:
    latest, history = jobs.book_table(i.scratch("latest")), i.scratch("history")
    stream = json_stream(i, i.books.select(*BOOK_TOP.fieldNames()), BOOK_TOP)
    await_all([jobs.start_book(stream, latest, history, i.scratch("checkpoint"), None)])
    columns = BOOK_TOP.fieldNames()
    kept = i.spark.read.parquet(history).select(*columns, F.lit("history").alias("kind"))
    return kept.unionByName(latest.read(i.spark).select(*columns, F.lit("latest").alias("kind")))


@query("stream_ranking_complete", "SELECT * FROM ranking", "percent_change")
def _ranking(i: Inputs) -> DataFrame:
    path = i.scratch("ranking")
    stream = json_stream(i, i.trades, TRADE, max_files=2)
    await_all([jobs.start_ranking(stream, path, i.scratch("checkpoint"), None)])
    return read_latest(i.spark, path)


@query("stream_upsert_idempotent", "SELECT * FROM bars_1d", SUMS)
def _replay(i: Inputs) -> DataFrame:
    """The whole stream processed twice into one table, by two checkpoints."""
    table = CandleTable(i.scratch("candles"))
    stream = json_stream(i, i.trades, TRADE)
    for _ in range(2):
        await_all([jobs.start_ohlcv(stream, "1d", table, i.scratch("checkpoint"), every=None)])
    return table.read(i.spark).select(*BAR_COLUMNS)


@query(
    "stream_multi_query",
    "SELECT * FROM bars_4h UNION ALL SELECT * FROM bars_1d",
    SUMS,
)
def _several(i: Inputs) -> DataFrame:
    stream = json_stream(i, i.trades, TRADE)
    checkpoint = i.scratch("checkpoint")
    stored = {interval: CandleTable(i.scratch(interval)) for interval in ("4h", "1d")}
    await_all([jobs.start_ohlcv(stream, n, table, checkpoint, every=None) for n, table in stored.items()])
    both = stored["4h"].read(i.spark).unionByName(stored["1d"].read(i.spark))
    return both.select(*BAR_COLUMNS)


@query(
    "stream_rate_limit",
    "SELECT CAST(trade_id % 4 AS BIGINT) AS file, count(*) AS input_rows, count(*) AS output_rows FROM tape GROUP BY ALL",
)
def _limited(i: Inputs) -> DataFrame:
    """Four files under a ceiling of one file for each micro-batch, as the broker's ceiling of
    records does there: the sizes of the batches are those of the files."""
    path = i.scratch("messages")
    text = F.to_json(F.struct(*i.trades.columns)).alias("value")
    for file in range(4):
        i.trades.where(F.col("trade_id") % 4 == file).select(text).coalesce(1).write.mode("append").text(path)
    stream = decode_json(read_files(i.stream_spark, path, max_files=1), TRADE)
    log = ProgressLog(i.stream_spark)
    running = jobs.start_append(stream, "limited", i.scratch("trades"), i.scratch("checkpoint"))
    await_all([running])
    sizes = log.close([running]).where("query = 'limited' AND input_rows > 0")
    return sizes.select(F.col("batch_id").alias("file"), "input_rows", "output_rows")


@query(
    "stream_batch_metrics",
    "SELECT 'trades' AS query, count(*) AS input_rows, count(*) AS output_rows, CAST(0 AS BIGINT) AS dropped_late FROM tape",
)
def _progress(i: Inputs) -> DataFrame:
    stream = json_stream(i, i.trades, TRADE)
    log = ProgressLog(i.stream_spark, i.scratch("progress"))
    running = jobs.start_append(stream, "trades", i.scratch("trades"), i.scratch("checkpoint"))
    await_all([running])
    frame = log.close([running]).where("query = 'trades'")
    return frame.groupBy("query").agg(*(F.sum(c).alias(c) for c in ("input_rows", "output_rows", "dropped_late")))


@query("stream_checkpointed_write", "SELECT symbol, trade_id, price FROM tape")
def _restart(i: Inputs) -> DataFrame:
    """A query started again from its checkpoint adds nothing it has already written."""
    path, checkpoint = i.scratch("trades"), i.scratch("checkpoint")
    stream = json_stream(i, i.trades, TRADE).select("symbol", "trade_id", "price")
    for _ in range(2):
        await_all([jobs.start_append(stream, "trades", path, checkpoint)])
    return i.spark.read.parquet(path)


#: Delivery a trade belongs to, and the one it comes with.
OWN_DELIVERY = f"CAST(least(3, greatest(0, floor((trade_time - {FIRST_DAY}) / (7.5 * 86400000)))) AS INT)"
ARRIVAL = "CASE WHEN trade_id % 10 = 0 THEN _own + 2 ELSE _own END"

#: A delivery is held against the newest time of all deliveries up to the one before last.
LATE = f"""SELECT symbol, '5m' AS interval, w AS open_time, w + 300000 AS close_time,
  first(price ORDER BY trade_time, trade_id) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY trade_time, trade_id) AS close, sum(quantity) AS volume, sum(price * quantity) AS quote_volume,
  count(*) AS trades, sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS taker_buy_volume,
  sum(price * quantity) / nullif(sum(quantity), 0) AS vwap
FROM (SELECT t.*, trade_time - trade_time % 300000 AS w,
    (SELECT max(o.trade_time) FROM arrived o WHERE o.arrives <= t.arrives - 2) - 600000 AS watermark FROM arrived t)
WHERE watermark IS NULL OR w + 300000 > watermark GROUP BY symbol, w"""


@query("stream_watermark_late", LATE, SUMS)
def _late(i: Inputs) -> DataFrame:
    """Five-minute candles of trades in four deliveries, a quarter of the days each; every
    tenth trade arrives two deliveries late and is dropped unless its candle is still open."""
    trades = i.trades.withColumn("_own", F.expr(OWN_DELIVERY))
    trades = trades.withColumn("_arrives", F.expr(ARRIVAL))
    text = F.to_json(F.struct(*i.trades.columns)).alias("value")
    path = i.scratch("messages")
    for delivery in range(6):  # one file each, in order
        trades.where(F.col("_arrives") == delivery).select(text).coalesce(1).write.mode("append").text(path)
    stream = decode_json(read_files(i.stream_spark, path, max_files=1), TRADE)
    table = CandleTable(i.scratch("candles"))
    return stored_candles(i, table, [jobs.start_ohlcv(stream, "5m", table, i.scratch("checkpoint"), every=None)])
