"""Range, page and latest queries, latest-value tables, retention and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.operators import ranking, serving, state
from tapewright.operators.candles import BAR_COLUMNS
from tapewright.schemas import TTL_SECONDS
from tapewright.sources import sinks
from tapewright.suite.inputs import AS_OF, Inputs
from tapewright.suite.market_queries import ranked
from tapewright.suite.registry import query

SUMS = "quote_volume vwap"
BOUND = 1_705_500_000_000


@query(
    "candles_latest_n",
    f"""SELECT * FROM bars_5m WHERE symbol = 'click' AND open_time BETWEEN {BOUND} AND {AS_OF}
ORDER BY open_time DESC LIMIT 200""",
    SUMS,
)
def _latest_n(i: Inputs) -> DataFrame:
    return serving.candles_latest(i.bars("5m"), "click", "5m", 200, BOUND, AS_OF)


KLINE_PAGE = "SELECT * EXCLUDE (ingestion_time) FROM klines_1m WHERE symbol = 'view'"


def _page_source(i: Inputs) -> DataFrame:
    return i.klines("1m").drop("ingestion_time")


@query(
    "candles_page_before",
    f"SELECT * FROM ({KLINE_PAGE} AND open_time < {BOUND} ORDER BY open_time DESC LIMIT 200) WHERE is_closed",
    "quote_volume",
)
def _before(i: Inputs) -> DataFrame:
    return serving.candles_page_before(_page_source(i), "view", BOUND)


@query(
    "candles_page_until",
    f"SELECT * FROM ({KLINE_PAGE} AND open_time <= {BOUND} ORDER BY open_time LIMIT 200) WHERE is_closed",
    "quote_volume",
)
def _until(i: Inputs) -> DataFrame:
    return serving.candles_page_until(_page_source(i), "view", BOUND)


@query(
    "candles_closed_window",
    f"SELECT * FROM ({KLINE_PAGE} ORDER BY open_time DESC LIMIT 100) WHERE is_closed",
    "quote_volume",
)
def _closed(i: Inputs) -> DataFrame:
    return serving.candles_closed(_page_source(i), "view")


@query(
    "trades_latest_n",
    "SELECT * EXCLUDE (user_id) FROM tape WHERE symbol = 'purchase' ORDER BY trade_time DESC, trade_id DESC LIMIT 50",
)
def _trades(i: Inputs) -> DataFrame:
    return serving.trades_latest(i.tape, "purchase")


@query(
    "prediction_history",
    "SELECT * FROM predictions WHERE symbol = 'click' ORDER BY prediction_time DESC LIMIT 50",
    "predicted_price predicted_change_pct return_1 rsi volatility_5 volume_ratio",
)
def _history(i: Inputs) -> DataFrame:
    return serving.prediction_history(i.predictions, "click")


@query(
    "predictions_by_change",
    "SELECT symbol, open_time, predicted_change_pct, direction FROM predictions ORDER BY predicted_change_pct DESC",
    "predicted_change_pct",
)
def _by_change(i: Inputs) -> DataFrame:
    return serving.predictions_by_change(i.predictions).select(
        "symbol", "open_time", "predicted_change_pct", "direction"
    )


@query(
    "state_latest_candle",
    """SELECT * EXCLUDE (ingestion_time) FROM klines
QUALIFY row_number() OVER (PARTITION BY symbol, interval ORDER BY open_time DESC) = 1""",
    "quote_volume",
)
def _latest_candle(i: Inputs) -> DataFrame:
    return state.latest_candle(i.klines().drop("ingestion_time"))


@query(
    "state_ticker",
    """SELECT symbol, close AS price, volume AS bar_volume, open_time AS updated_at FROM bars_1m
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1""",
)
def _ticker(i: Inputs) -> DataFrame:
    return state.ticker(i.bars("1m"))


@query(
    "state_recent_trades",
    """SELECT * EXCLUDE (user_id) FROM tape
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_time DESC, trade_id DESC) <= 100""",
)
def _recent(i: Inputs) -> DataFrame:
    # Every trade arrives twice.
    return state.recent_trades(i.tape.unionByName(i.tape))


@query(
    "state_latest_prediction",
    f"""SELECT symbol, close AS current_price, predicted_price, predicted_change_pct AS predicted_change, direction,
  prediction_time, target_time, abs(predicted_change_pct) AS confidence_score
FROM predictions WHERE open_time + 3600000 <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY prediction_time DESC) = 1""",
    "predicted_price predicted_change confidence_score",
)
def _prediction(i: Inputs) -> DataFrame:
    return state.latest_prediction(i.predictions.where(F.col("open_time") + 3_600_000 <= AS_OF))


@query("state_ranking", "SELECT * FROM ranking", "percent_change")
def _ranking(i: Inputs) -> DataFrame:
    path = i.scratch("ranking")
    for _ in range(2):  # replaced as a whole each time
        sinks.replace_table(ranking.top_n(ranked(i)), path)
    return sinks.read_latest(i.spark, path)


@query(
    "retention_filter",
    f"SELECT symbol, open_time, close FROM bars_1m WHERE open_time > {AS_OF - 86_400_000}",
)
def _retain(i: Inputs) -> DataFrame:
    return state.retain(i.bars("1m"), TTL_SECONDS["candles_1m"], AS_OF).select("symbol", "open_time", "close")


@query(
    "unique_key_check",
    """SELECT symbol, interval, open_time, count(*) AS copies
FROM (SELECT * FROM klines UNION ALL SELECT * FROM klines WHERE NOT is_closed)
GROUP BY ALL HAVING count(*) > 1""",
)
def _unique(i: Inputs) -> DataFrame:
    bars = i.klines()
    again = bars.unionByName(bars.where(~F.col("is_closed")))
    return state.duplicate_keys(again, ["symbol", "interval", "open_time"])


@query(
    "sink_candle_upsert",
    f"""SELECT *, CASE WHEN open_time >= {BOUND} THEN 'second' ELSE 'first' END AS source FROM bars_4h""",
    SUMS,
)
def _upsert(i: Inputs) -> DataFrame:
    """A first load, then corrected later candles twice: the second time changes nothing."""
    table = sinks.CandleTable(i.scratch("candles"))
    bars = i.bars("4h")
    table.upsert(bars.withColumn("close", F.lit(0.0)).withColumn("source", F.lit("first")))
    table.upsert(bars.where(F.col("open_time") < BOUND).withColumn("source", F.lit("first")))
    for _ in range(2):
        table.upsert(bars.where(F.col("open_time") >= BOUND).withColumn("source", F.lit("second")))
    return table.read(i.spark).select(*BAR_COLUMNS, "source")


@query(
    "sink_append",
    """SELECT symbol, best_bid, best_ask, spread, timestamp, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS date
FROM tops""",
    "spread",
)
def _append(i: Inputs) -> DataFrame:
    """The history gets the early books, then the late ones twice under one batch name."""
    path = i.scratch("books")
    tops = i.stored(i.books.select("symbol", "best_bid", "best_ask", "spread", "timestamp"), "tops")
    early = F.col("timestamp") < BOUND
    sinks.append_once(tops.where(early), path, "timestamp", "0")
    for _ in range(2):
        sinks.append_once(tops.where(~early), path, "timestamp", "1")
    return i.spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
