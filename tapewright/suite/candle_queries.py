"""Candles: from trades, rolled up, cascaded, filtered and shaped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import candle
from tapewright.operators import candles as op
from tapewright.operators.joins import active_symbols, join_dim
from tapewright.schemas import CASCADE, SOURCE_TAG, WIDTH_MS
from tapewright.sources import tables
from tapewright.sources.sinks import CandleTable, write_partitions
from tapewright.suite.inputs import AS_OF, Inputs
from tapewright.suite.registry import query
from tapewright.suite.sql import rollup

SUMS = "quote_volume vwap"

for _name in WIDTH_MS:

    @query(
        f"ohlcv_from_trades_{_name}",
        f"SELECT b.*, name, category FROM bars_{_name} b LEFT JOIN dim USING (symbol)",
        SUMS,
    )
    def _ohlcv(i: Inputs, interval: str = _name) -> DataFrame:
        return op.ohlcv(i.tape, interval, i.dim)


@query(
    "agg_vwap",
    "SELECT symbol, sum(price * quantity) / nullif(sum(quantity), 0) AS vwap FROM tape GROUP BY symbol",
    "vwap",
)
def _vwap(i: Inputs) -> DataFrame:
    sums = i.tape.groupBy("symbol").agg(
        F.sum(F.col("price") * F.col("quantity")).alias("quote"), F.sum("quantity").alias("volume")
    )
    return sums.select("symbol", candle.vwap(F.col("quote"), F.col("volume")).alias("vwap"))


@query("agg_taker_buy_volume", "SELECT symbol, open_time, taker_buy_volume FROM bars_1h")
def _taker(i: Inputs) -> DataFrame:
    return op.ohlcv(i.tape, "1h").select("symbol", "open_time", "taker_buy_volume")


@query("ohlc_rollup", rollup("bars_1m", WIDTH_MS["1h"], "1h"), SUMS)
def _rollup(i: Inputs) -> DataFrame:
    return op.rollup(i.bars("1m"), "1h")


for _step in range(1, len(CASCADE)):

    def _chain(step: int) -> str:
        source = "bars_1m"
        for interval in CASCADE[1 : step + 1]:
            source = f"({rollup(source, WIDTH_MS[interval], interval)})"
        return source

    @query(
        f"ohlc_cascade_{CASCADE[_step]}",
        f"SELECT *, '{SOURCE_TAG[CASCADE[_step]]}' AS source FROM {_chain(_step)}",
        SUMS,
    )
    def _cascade(i: Inputs, interval: str = CASCADE[_step]) -> DataFrame:
        return op.cascade(i.bars("1m"), interval)


def _closed_sql(interval: str) -> str:
    start, end = op.last_closed_bounds(interval, AS_OF)
    finer = CASCADE[CASCADE.index(interval) - 1]
    source = f"(SELECT * FROM bars_{finer} WHERE open_time >= {start} AND open_time < {end})"
    return f"SELECT *, '{SOURCE_TAG[interval]}' AS source FROM ({rollup(source, WIDTH_MS[interval], interval)})"


@query(
    "last_closed_window",
    " UNION ALL ".join(_closed_sql(interval) for interval in CASCADE[1:]),
    SUMS,
)
def _last_closed(i: Inputs) -> DataFrame:
    parts = None
    for finer, interval in zip(CASCADE, CASCADE[1:]):
        step = op.cascade_step(i.bars(finer), interval, AS_OF)
        parts = step if parts is None else parts.unionByName(step)
    return parts


@query("proj_quote_volume", "SELECT symbol, trade_id, price * quantity AS quote_volume FROM tape")
def _quote(i: Inputs) -> DataFrame:
    return i.tape.select("symbol", "trade_id", (F.col("price") * F.col("quantity")).alias("quote_volume"))


@query(
    "proj_epoch_ms_to_ts",
    "SELECT symbol, trade_id, strftime(make_timestamp(trade_time * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts FROM tape",
)
def _ts(i: Inputs) -> DataFrame:
    ts = candle.event_ts(F.col("trade_time"))
    return i.tape.select("symbol", "trade_id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"))


@query("filter_closed_1m", "SELECT * FROM klines WHERE interval = '1m' AND is_closed", "quote_volume")
def _closed(i: Inputs) -> DataFrame:
    return op.closed_bars(i.klines(), "1m")


GEOMETRY = """SELECT symbol, open_time, (close - open) / nullif(open, 0) * 100 AS price_change_pct,
  CASE WHEN close >= open THEN 'bullish' ELSE 'bearish' END AS candle_type, abs(close - open) AS body_size,
  high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow FROM bars_5m"""


@query("candle_geometry_stream", GEOMETRY, "price_change_pct body_size upper_shadow lower_shadow")
def _geometry(i: Inputs) -> DataFrame:
    return op.geometry(i.bars("5m")).select(
        "symbol", "open_time", "price_change_pct", "candle_type", "body_size", "upper_shadow", "lower_shadow"
    )


@query(
    "candle_geometry_batch",
    """SELECT symbol, open_time, high - low AS price_range, close - open AS body_size,
  high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow FROM bars_5m""",
    "price_range body_size upper_shadow lower_shadow",
)
def _signed(i: Inputs) -> DataFrame:
    return op.signed_geometry(i.bars("5m")).select(
        "symbol", "open_time", "price_range", "body_size", "upper_shadow", "lower_shadow"
    )


START, END = 1_705_000_000_000, 1_705_900_000_000


@query("filter_time_range", f"SELECT * FROM bars_1h WHERE open_time BETWEEN {START} AND {END}", SUMS)
def _range(i: Inputs) -> DataFrame:
    return tables.time_range(i.bars("1h"), START, END)


@query("filter_symbol_in", "SELECT * FROM bars_1h WHERE symbol IN ('click', 'view')", SUMS)
def _symbols(i: Inputs) -> DataFrame:
    return i.bars("1h").where(F.col("symbol").isin("click", "view"))


@query("filter_symbol_eq", "SELECT * EXCLUDE (user_id) FROM tape WHERE symbol = 'click'")
def _symbol(i: Inputs) -> DataFrame:
    return i.tape.where(F.col("symbol") == "click")


@query(
    "candle_project",
    """SELECT symbol, interval, open_time, close_time, open, high, low, close, volume, quote_volume, trades,
  'spark_stream' AS source FROM bars_1h""",
    "quote_volume",
)
def _project(i: Inputs) -> DataFrame:
    columns = [c for c in op.BAR_COLUMNS if c not in ("taker_buy_volume", "vwap")]
    return i.bars("1h").select(*columns, F.lit("spark_stream").alias("source"))


@query(
    "chart_point_project",
    """SELECT symbol, open_time // 1000 AS time, open, high, low, close, volume, close >= open AS is_up
FROM bars_1h WHERE open_time // 1000 > 0""",
)
def _chart(i: Inputs) -> DataFrame:
    return op.chart_points(i.bars("1h"))


@query(
    "join_broadcast_dim",
    "SELECT t.symbol, trade_id, price, name, base, category FROM tape t LEFT JOIN dim USING (symbol)",
)
def _dim(i: Inputs) -> DataFrame:
    return join_dim(i.tape.select("symbol", "trade_id", "price"), i.dim.drop("rank"))


@query(
    "semi_active_symbols",
    f"""SELECT * FROM bars_4h WHERE symbol IN
  (SELECT symbol FROM bars_1m WHERE open_time >= {AS_OF - 3_600_000} AND open_time < {AS_OF})""",
    SUMS,
)
def _active(i: Inputs) -> DataFrame:
    recent = i.bars("1m").where(F.col("open_time").between(AS_OF - 3_600_000, AS_OF - 1))
    return active_symbols(i.bars("4h"), recent)


@query(
    "scan_candles_range",
    f"""SELECT * FROM candle_table WHERE interval = '1h' AND symbol IN ('click', 'view', 'error') AND open_time >= {START} AND open_time < {END}""",
    SUMS,
)
def _scan(i: Inputs) -> DataFrame:
    stored = i.scratch("candles")
    write_partitions(i.candle_table, stored, ["interval", "date"])
    scanned = tables.scan_candles(CandleTable(stored).read(i.spark), "1h", ["click", "view", "error"], START, END)
    return scanned.select(*op.BAR_COLUMNS)


@query(
    "scan_training_window",
    f"SELECT * FROM bars_5m WHERE open_time BETWEEN {AS_OF - 30 * 86_400_000} AND {AS_OF}",
    SUMS,
)
def _training(i: Inputs) -> DataFrame:
    return tables.scan_training_window(i.bars("5m"), AS_OF)


@query(
    "scan_recent_lookback",
    f"SELECT * FROM bars_5m WHERE open_time >= {AS_OF - 40 * 300_000} AND close_time <= {AS_OF}",
    SUMS,
)
def _recent(i: Inputs) -> DataFrame:
    return tables.scan_recent(i.bars("5m"), AS_OF)


@query(
    "scalar_candle_bucket",
    """SELECT symbol, trade_id, trade_time - trade_time % 300000 AS start_5m, trade_time - trade_time % 14400000 AS start_4h,
  strftime(make_timestamp((trade_time + 300000) // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS target FROM tape""",
)
def _bucket(i: Inputs) -> DataFrame:
    time = F.col("trade_time")
    return i.tape.select(
        "symbol",
        "trade_id",
        candle.bucket_start(time, 300_000).alias("start_5m"),
        candle.bucket_start(time, 14_400_000).alias("start_4h"),
        F.from_unixtime(F.expr("(trade_time + 300000) div 1000")).alias("target"),
    )
