"""Messages: decoding, normalising, routing, aliases and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.schemas import CANDLE, TRADE
from tapewright.sources import decode, tables
from tapewright.suite.inputs import AS_OF, PARAMS, Inputs
from tapewright.suite.registry import query

FULL_TRADE = """SELECT symbol, trade_id, price, quantity, trade_time, is_buyer_maker, {best} AS is_best_match,
  trade_time AS event_time FROM tape"""


def canonical_messages(i: Inputs) -> DataFrame:
    """Canonical trade JSON; trades without quantity are cut short."""
    text = F.to_json(F.struct(*i.trades.columns))
    return i.trades.select(F.when(F.col("quantity") > 0, text).otherwise(F.substring(text, 1, 5)).alias("value"))


@query(
    "json_decode_typed",
    FULL_TRADE.format(best="true") + " WHERE quantity > 0",
)
def _decode(i: Inputs) -> DataFrame:
    return decode.decode_json(canonical_messages(i), TRADE).drop("ingestion_time")


@query("json_quarantine", "SELECT count(*) AS broken FROM tape WHERE quantity = 0")
def _quarantine(i: Inputs) -> DataFrame:
    return decode.quarantine(canonical_messages(i), TRADE).agg(F.count("*").alias("broken"))


@query("raw_trade_normalize", FULL_TRADE.format(best="is_buyer_maker") + " WHERE quantity > 0")
def _trade(i: Inputs) -> DataFrame:
    return decode.normalize_trade(i.trade_messages).drop("ingestion_time")


@query("raw_kline_normalize", "SELECT * EXCLUDE (ingestion_time) FROM klines_1h", "quote_volume")
def _kline(i: Inputs) -> DataFrame:
    return decode.normalize_kline(i.kline_messages()).drop("ingestion_time")


@query(
    "raw_depth_normalize",
    """SELECT upper(t.symbol) AS symbol, t.timestamp, best_bid, best_ask, spread, spread_valid, bid_levels, ask_levels,
  bid_quantity, ask_quantity
FROM tops t JOIN (SELECT symbol, timestamp, CAST(count_if(side = 'bid') AS INTEGER) AS bid_levels,
  CAST(count_if(side = 'ask') AS INTEGER) AS ask_levels,
  sum(CASE WHEN side = 'bid' THEN quantity ELSE 0 END) AS bid_quantity,
  sum(CASE WHEN side = 'ask' THEN quantity ELSE 0 END) AS ask_quantity
  FROM levels WHERE level <= 20 GROUP BY ALL) l USING (symbol, timestamp)""",
    "spread",
)
def _depth(i: Inputs) -> DataFrame:
    from tapewright.functions.book import side_quantity

    routed = decode.route_messages(i.depth_messages)
    books = decode.normalize_depth(routed, F.col("stream_symbol"), F.col("timestamp"), "payload")
    return books.select(
        "*",
        F.size("bids").alias("bid_levels"),
        F.size("asks").alias("ask_levels"),
        side_quantity(F.col("bids"), 20).alias("bid_quantity"),
        side_quantity(F.col("asks"), 20).alias("ask_quantity"),
    ).drop("bids", "asks")


def mixed_messages(i: Inputs) -> DataFrame:
    """Trades in an envelope and bare, hourly candles, books and broken records."""
    enveloped = F.concat(F.lit('{"stream":"x@trade","data":'), F.col("value"), F.lit("}"))
    trades = i.trade_messages.select(
        F.when(F.col("trade_time") < AS_OF, enveloped).otherwise(F.col("value")).alias("value")
    )
    return trades.unionByName(i.kline_messages()).unionByName(i.depth_messages.select("value"))


@query(
    "message_route",
    """SELECT 'trade' AS kind, symbol, count(*) AS messages FROM tape WHERE quantity > 0 GROUP BY symbol
UNION ALL SELECT 'kline', symbol, count(*) FROM klines_1h GROUP BY symbol
UNION ALL SELECT 'depth', upper(symbol), count(*) FROM tops GROUP BY symbol
UNION ALL SELECT 'unrouted', 'none', count(*) FROM tape WHERE quantity = 0""",
)
def _route(i: Inputs) -> DataFrame:
    routed = decode.route_messages(mixed_messages(i))
    symbol = (
        F.when(F.col("kind") == "trade", F.get_json_object("payload", "$.s"))
        .when(F.col("kind") == "kline", F.get_json_object("payload", "$.k.s"))
        .when(F.col("kind") == "depth", F.col("stream_symbol"))
    )
    labelled = routed.select(
        F.coalesce("kind", F.lit("unrouted")).alias("kind"), F.coalesce(symbol, F.lit("none")).alias("symbol")
    )
    return labelled.groupBy("kind", "symbol").agg(F.count("*").alias("messages"))


@query(
    "symbol_interval_filter_stream",
    """SELECT symbol, interval, open_time, close FROM klines WHERE symbol = 'click' AND interval = '5m'
UNION ALL SELECT symbol, '', trade_time, price FROM tape WHERE symbol = 'click'""",
)
def _filter(i: Inputs) -> DataFrame:
    bars = i.klines().select("symbol", "interval", "open_time", "close")
    plain = i.tape.select(
        "symbol", F.lit("").alias("interval"), F.col("trade_time").alias("open_time"), F.col("price").alias("close")
    )
    return decode.symbol_interval_filter(bars.unionByName(plain), "click", "5m")


ALIAS_COLUMNS = (
    "symbol, interval, open_time, close_time, open, high, low, close, volume, quote_volume, trades_count, is_closed"
)


@query(
    "alias_coalesce",
    f"""SELECT {ALIAS_COLUMNS} FROM klines_1h UNION ALL
SELECT symbol, '1m' AS interval, open_time, close_time, open, high, low, close, volume, 0, 0, is_closed FROM klines_5m""",
    "quote_volume",
)
def _alias(i: Inputs) -> DataFrame:
    long = i.klines("1h")
    long_text = long.select(F.to_json(F.struct(*long.columns)).alias("value"))
    short = i.klines("5m").select(
        F.to_json(
            F.struct(
                F.col("symbol").alias("s"),
                F.col("open_time").alias("t"),
                F.col("close_time").alias("T"),
                F.col("open").cast("string").alias("o"),
                F.col("high").cast("string").alias("h"),
                F.col("low").cast("string").alias("l"),
                F.col("close").cast("string").alias("c"),
                F.col("volume").cast("string").alias("v"),
                F.col("is_closed").alias("x"),
            )
        ).alias("value")
    )
    return decode.alias_coalesce(long_text.unionByName(short))


@query(
    "kline_update_tag",
    """SELECT symbol, interval, open_time, CASE WHEN is_closed THEN 'realtime' ELSE 'update' END AS type FROM klines""",
)
def _tag(i: Inputs) -> DataFrame:
    return decode.tag_update(i.klines()).select("symbol", "interval", "open_time", "type")


@query(
    "doc_type_normalize",
    """SELECT symbol, interval, open_time, close_time, open, high, low, close, volume,
  CASE WHEN volume > 0 THEN quote_volume END AS quote_volume, trades, CAST(NULL AS DOUBLE) AS taker_buy_volume, CAST(NULL AS DOUBLE) AS vwap
FROM bars_1h""",
    "quote_volume",
)
def _types(i: Inputs) -> DataFrame:
    bars = i.bars("1h").drop("taker_buy_volume", "vwap")
    texts = bars.select(*(F.col(c).cast("string").alias(c) for c in bars.columns))
    unsure = texts.withColumn(
        "quote_volume", F.when(F.col("volume") != "0.0", F.col("quote_volume")).otherwise("n/a")
    )
    return decode.normalize_types(unsure, CANDLE)


@query(
    "scalar_json_roundtrip",
    """SELECT symbol, trade_id, price, quantity, trade_time, is_buyer_maker,
  CAST(price AS VARCHAR) AS price_text, CAST(trade_id AS VARCHAR) AS id_text FROM tape""",
)
def _roundtrip(i: Inputs) -> DataFrame:
    tape = i.tape
    packed = tape.select(F.to_json(F.struct(*tape.columns)).alias("value"))
    back = packed.select(
        F.from_json("value", TRADE).alias("d"),
        F.get_json_object("value", "$.price").alias("price_text"),
        F.get_json_object("value", "$.trade_id").alias("id_text"),
    )
    return back.select(*(f"d.{c}" for c in tape.columns), "price_text", "id_text")


@query(
    "src_model_params",
    """SELECT * FROM (SELECT unnest(['return_1', 'return_2', 'rsi', 'volume_ratio']) AS feature,
  unnest([avg(return_1), avg(return_2), avg(rsi), avg(volume_ratio)]) AS mean,
  unnest([stddev_samp(return_1), stddev_samp(return_2), stddev_samp(rsi), stddev_samp(volume_ratio)]) AS std,
  unnest([-0.5, 0.125, -1.5, 0.0]::DOUBLE[]) AS coefficient, 0.25::DOUBLE AS intercept FROM training)""",
    "mean std",
)
def _params(i: Inputs) -> DataFrame:
    """Scaler statistics of the data and fixed weights, stored and read back; the
    weight of one feature is left out and defaults to 0."""
    names = ["return_1", "return_2", "rsi", "volume_ratio"]

    def per_feature(function):
        return F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(function, names)))

    weights = {n: PARAMS["coefficients"][n] for n in names[:3]}
    params = i.training.agg(
        F.lit(PARAMS["model_type"]).alias("model_type"),
        F.array(*map(F.lit, names)).alias("features"),
        F.lit(PARAMS["intercept"]).alias("intercept"),
        F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)).alias("coefficients"),
        per_feature(F.avg).alias("scaler_mean"),
        per_feature(F.stddev_samp).alias("scaler_std"),
    )
    path = i.scratch("params")
    params.write.json(path)
    return tables.coefficient_table(tables.read_model_params(i.spark, path))
