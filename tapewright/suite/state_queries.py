"""Streaming queries with state of their own, run over deliveries in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.operators.candles import BAR_COLUMNS
from tapewright.operators.joins import lookup_hot_cold
from tapewright.operators.state import latest_prediction
from tapewright.schemas import BOOK_TOP, CANDLE, LATENESS, PREDICTION, TRADE, TTL_SECONDS, WIDTH_MS
from tapewright.sources.decode import decode_json
from tapewright.sources.sinks import CandleTable
from tapewright.sources.streams import read_files
from tapewright.streaming import jobs, stateful
from tapewright.streaming.supervise import await_all
from tapewright.suite.feature_queries import SHOWN
from tapewright.suite.inputs import AS_OF, FIRST_DAY, Inputs
from tapewright.suite.registry import query
from tapewright.suite.sql import rollup
from tapewright.suite.stream_queries import ARRIVAL, OWN_DELIVERY, SUMS, drained

DAY = WIDTH_MS["1d"]


class Deliveries:
    """Rows as JSON messages in files that a stream reads one after the other."""

    def __init__(self, i: Inputs, rows: DataFrame, schema: T.StructType, arrives: Column):
        self.i, self.schema, self.columns = i, schema, schema.fieldNames()
        self.rows, self.path = i.stored(rows.withColumn("_arrives", arrives), "arrivals"), i.scratch("messages")

    def deliver(self, *numbers: int) -> None:
        text = F.to_json(F.struct(*self.columns)).alias("value")
        for number in numbers:
            self.rows.where(F.col("_arrives") == number).select(text).coalesce(1).write.mode("append").text(self.path)

    def stream(self, max_files: int | None = 1) -> DataFrame:
        return decode_json(read_files(self.i.stream_spark, self.path, max_files=max_files), self.schema)


@query(
    "stream_recent_trades",
    """SELECT symbol, trade_id, price, quantity, trade_time, is_buyer_maker FROM tape
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_time DESC, trade_id DESC) <= 100""",
)
def _recent(i: Inputs) -> DataFrame:
    """Every trade comes twice, a third of the rows out of order; the query is stopped between
    deliveries and started again."""
    twice = i.trades.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    arrives = F.pmod(F.col("trade_id") + F.col("_copy"), F.lit(3)).cast("int")
    feed = Deliveries(i, twice, TRADE, arrives)
    table, checkpoint = stateful.recent_table(i.scratch("recent")), i.scratch("checkpoint")
    for numbers in ((0, 1), (2,)):
        feed.deliver(*numbers)
        await_all([stateful.start_recent_trades(feed.stream(), table, checkpoint, None)])
    return table.read(i.spark).select("symbol", "trade_id", "price", "quantity", "trade_time", "is_buyer_maker")


HOUR = WIDTH_MS["1h"]

#: A forecast whose bar never came is reported once both streams are a bar width past its time.
PENDING = f"""(SELECT least((SELECT max(open_time) + {HOUR} FROM predictions), (SELECT max(open_time) FROM bars_1h)) - 300000)"""


@query(
    "stream_prediction_actual",
    f"""SELECT p.symbol, p.open_time, p.close, predicted_price, b.close AS actual_price,
  (b.close - p.close) / nullif(p.close, 0) * 100 AS actual_change,
  CASE WHEN b.close <> 0 THEN greatest(100 - abs((predicted_price - b.close) / b.close * 100), 0) END AS accuracy
FROM predictions p LEFT JOIN bars_1h b ON b.symbol = p.symbol AND b.open_time = p.open_time + {HOUR}
WHERE b.close IS NOT NULL OR p.open_time + {HOUR} + {HOUR} <= {PENDING}""",
    "predicted_price actual_change accuracy",
)
def _actuals(i: Inputs) -> DataFrame:
    """Forecasts and bars of two halves of the time, read as two streams."""
    half = F.when(F.col("open_time") < FIRST_DAY + 15 * DAY, 0).otherwise(1)
    columns = ["symbol", "open_time", "close", "predicted_price"]
    made = Deliveries(i, i.predictions.select(*columns), T.StructType([PREDICTION[c] for c in columns]), half)
    bars = Deliveries(i, i.bars("1h"), CANDLE, half)
    for feed in (made, bars):
        feed.deliver(0, 1)
    table = stateful.realised_table(i.scratch("realised"))
    await_all([stateful.start_actuals(made.stream(), bars.stream(), table, i.scratch("checkpoint"), "1h", None)])
    return table.read(i.spark).drop("shard")


#: Trades that reach their one-minute candle in time, and the final watermark.
ON_TIME = """SELECT * FROM (SELECT t.*,
    (SELECT max(o.trade_time) FROM arrived o WHERE o.arrives <= t.arrives - 2) - 600000 AS watermark FROM arrived t)
WHERE watermark IS NULL OR trade_time - trade_time % 60000 + 60000 > watermark"""
FINEST = f"""SELECT symbol, trade_time - trade_time % 60000 AS open_time, trade_time - trade_time % 60000 + 60000 AS close_time,
  first(price ORDER BY trade_time, trade_id) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY trade_time, trade_id) AS close, sum(quantity) AS volume, sum(price * quantity) AS quote_volume,
  count(*) AS trades, sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS taker_buy_volume
FROM ({ON_TIME}) GROUP BY symbol, trade_time - trade_time % 60000"""


def _cascade_sql(target: str) -> str:
    sql = f"({FINEST})"
    for interval in ("5m", "1h", "4h", "1d"):
        sql = f"({rollup(sql, WIDTH_MS[interval], interval)})"
        if interval == target:
            break
    return f"""SELECT {', '.join(BAR_COLUMNS)} FROM {sql}
WHERE close_time <= (SELECT max(trade_time) - 600000 FROM arrived)"""


for _target in ("5m", "1h", "4h", "1d"):

    @query(f"stream_cascade_{_target}", _cascade_sql(_target), SUMS)
    def _cascade(i: Inputs, target: str = _target) -> DataFrame:
        """Final candles of trades in six deliveries, a tenth of which come two deliveries late."""
        own = i.trades.withColumn("_own", F.expr(OWN_DELIVERY))
        feed = Deliveries(i, own, TRADE, F.expr(ARRIVAL))
        feed.deliver(*range(6))
        table = CandleTable(i.scratch("candles"))
        await_all([stateful.start_cascade(feed.stream(), target, table, i.scratch("checkpoint"), None)])
        return table.read(i.spark).select(*BAR_COLUMNS)


@query("stream_book_dedupe", "SELECT symbol, best_bid, best_ask, spread, timestamp FROM tops", "spread")
def _dedupe(i: Inputs) -> DataFrame:
    """Every snapshot comes twice, some of them again with the next delivery."""
    tops = i.books.select(*BOOK_TOP.fieldNames())
    twice = tops.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    part = F.col("timestamp") >= FIRST_DAY + 15 * DAY
    border = F.col("timestamp").between(FIRST_DAY + 14 * DAY, FIRST_DAY + 15 * DAY)
    feed = Deliveries(i, twice, BOOK_TOP, F.when(part | (border & (F.col("_copy") == 1)), 1).otherwise(0))
    feed.deliver(0, 1)
    return drained(i, stateful.dedupe(feed.stream(), "1 day"), "books")


@query("stream_features", f"SELECT symbol, open_time, {', '.join(stateful.FEATURE_COLUMNS)} FROM features", " ".join(stateful.FEATURE_COLUMNS))
def _features(i: Inputs) -> DataFrame:
    """Hourly bars in three deliveries, in order of time."""
    third = F.least(F.lit(2), F.floor((F.col("open_time") - FIRST_DAY) / (10 * DAY))).cast("int")
    feed = Deliveries(i, i.bars("1h"), CANDLE, F.greatest(F.lit(0), third))
    feed.deliver(0, 1, 2)
    found = drained(i, stateful.features(feed.stream()), "features")
    return found.select("symbol", "open_time", *(c for c in SHOWN if c in stateful.FEATURE_COLUMNS))


HOT = {f.name: f.dataType.simpleString() for f in PREDICTION.fields if f.name != "symbol"}


@query(
    "stream_lookup_hot_cold",
    f"""SELECT symbol, predicted_price, prediction_time,
  CASE WHEN open_time + {HOUR} + {TTL_SECONDS['latest_prediction'] * 1000} >= (SELECT max(open_time) + {HOUR} FROM predictions WHERE open_time + {HOUR} <= {AS_OF})
    THEN 'hot' ELSE 'cold' END AS tier
FROM predictions WHERE symbol IN (SELECT symbol FROM dim) AND open_time + {HOUR} <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY prediction_time DESC) = 1""",
    "predicted_price",
)
def _hot_cold(i: Inputs) -> DataFrame:
    """Latest predictions that expire by timers of the stream, before those of the batch."""
    made = F.col("open_time") + HOUR
    known = i.stored(i.predictions.where(made <= AS_OF), "predictions")
    feed = Deliveries(i, known, PREDICTION, F.when(F.col("open_time") < FIRST_DAY + 20 * DAY, 0).otherwise(1))
    feed.deliver(0, 1)
    table = stateful.expiring_table(i.scratch("hot"), HOT)
    await_all([stateful.start_expiring(feed.stream(), HOT, made, table, i.scratch("checkpoint"), every=None, lateness=LATENESS["klines"])])
    hot = latest_prediction(stateful.hot_rows(table, i.spark).drop("made_at"))
    found = lookup_hot_cold(i.dim.select("symbol"), hot, latest_prediction(known))
    return found.select("symbol", "predicted_price", "prediction_time", "tier")
