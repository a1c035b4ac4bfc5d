"""Record layouts and fixed values. Event times are epoch milliseconds (UTC)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


def _record(fields: str) -> T.StructType:
    """A flat layout from ``name TYPE, name TYPE`` (needs no running session)."""
    pairs = [text.split() for text in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: record layouts, which must equal the published messages and tables ---

TRADE = _record(
    "symbol STRING, trade_id BIGINT, price DOUBLE, quantity DOUBLE, trade_time BIGINT, "
    "is_buyer_maker BOOLEAN, is_best_match BOOLEAN, event_time BIGINT, ingestion_time BIGINT"
)

KLINE = _record(
    "symbol STRING, interval STRING, open_time BIGINT, close_time BIGINT, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trades_count INT, "
    "taker_buy_volume DOUBLE, is_closed BOOLEAN, event_time BIGINT, ingestion_time BIGINT"
)

BOOK_TOP = _record("symbol STRING, best_bid DOUBLE, best_ask DOUBLE, spread DOUBLE, timestamp BIGINT")

_LEVELS = T.ArrayType(_record("price DOUBLE, quantity DOUBLE"))
BOOK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("bids", _LEVELS),
        T.StructField("asks", _LEVELS),
        *BOOK_TOP.fields[1:],
    ]
)

#: Exchange wire formats: short keys, numbers as strings. Keys differ only by case, so
#: a decoded record is renamed by position to the matching ``*_NAMES`` layout.
RAW_TRADE = _record("e STRING, E BIGINT, s STRING, t BIGINT, p STRING, q STRING, T BIGINT, m BOOLEAN, M BOOLEAN")
RAW_TRADE_NAMES = (
    "struct<kind:string,event_time:bigint,symbol:string,trade_id:bigint,price:string,quantity:string,"
    "trade_time:bigint,is_buyer_maker:boolean,is_best_match:boolean>"
)
RAW_KLINE = _record("e STRING, E BIGINT").add(
    "k",
    _record(
        "s STRING, i STRING, t BIGINT, T BIGINT, o STRING, h STRING, l STRING, c STRING, v STRING, q STRING, "
        "n BIGINT, V STRING, x BOOLEAN"
    ),
)
RAW_KLINE_NAMES = (
    "struct<kind:string,event_time:bigint,k:struct<symbol:string,interval:string,open_time:bigint,"
    "close_time:bigint,open:string,high:string,low:string,close:string,volume:string,quote_volume:string,"
    "trades_count:bigint,taker_buy_volume:string,is_closed:boolean>>"
)
_PAIRS = T.ArrayType(T.ArrayType(T.StringType()))
RAW_DEPTH = T.StructType().add("bids", _PAIRS).add("asks", _PAIRS)

SYMBOL_METADATA = _record("symbol STRING, name STRING, base STRING, category STRING, rank INT")

CANDLE = _record(
    "symbol STRING, interval STRING, open_time BIGINT, close_time BIGINT, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, trades BIGINT, "
    "taker_buy_volume DOUBLE, vwap DOUBLE"
)

#: The stored candle table: one fixed layout for every writer, so partitions written by
#: different jobs read alike and no file footer is needed to know the columns. What a
#: writer does not provide is NULL.
STORED_CANDLE = T.StructType(
    [
        *CANDLE.fields,
        *_record("name STRING, category STRING, is_closed BOOLEAN, price_change_pct DOUBLE").fields,
        *_record("candle_type STRING, body_size DOUBLE, upper_shadow DOUBLE, lower_shadow DOUBLE").fields,
        *_record("first_open_time BIGINT, last_close_time BIGINT, event_time BIGINT").fields,
        *_record("created_at STRING, source STRING, date STRING").fields,
    ]
)

_NUMBERS = T.MapType(T.StringType(), T.DoubleType())
MODEL_PARAMS = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("coefficients", _NUMBERS),
        T.StructField("scaler_mean", _NUMBERS),
        T.StructField("scaler_std", _NUMBERS),
        T.StructField("metrics", _NUMBERS),
    ]
)

#: Span of one partition of the candle table per interval. A partition is what an upsert
#: rewrites and what one file holds: a day of minutes, but a year of daily candles.
PARTITION_SPAN = {"1m": "day", "5m": "day", "1h": "month", "4h": "month", "1d": "year"}

# --- fixed values: these must equal the published system's for equal results ---

#: A served prediction.
PREDICTION = _record(
    "symbol STRING, open_time BIGINT, close DOUBLE, predicted_price DOUBLE, predicted_change_pct DOUBLE, "
    "direction STRING, prediction_time STRING, target_time STRING, return_1 DOUBLE, rsi DOUBLE, "
    "volatility_5 DOUBLE, volume_ratio DOUBLE"
)

#: Candle widths in milliseconds.
WIDTH_MS = {"1m": 60_000, "5m": 300_000, "1h": 3_600_000, "4h": 14_400_000, "1d": 86_400_000}

#: Spark window durations of the same candles.
DURATION = {"1m": "1 minute", "5m": "5 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day"}

#: Symbol, name, base asset, category, rank.
SYMBOLS = [
    ("BTCUSDT", "Bitcoin", "BTC", "Layer 1", 1),
    ("ETHUSDT", "Ethereum", "ETH", "Layer 1", 2),
    ("BNBUSDT", "BNB", "BNB", "Exchange", 3),
    ("SOLUSDT", "Solana", "SOL", "Layer 1", 4),
    ("ADAUSDT", "Cardano", "ADA", "Layer 1", 5),
    ("XRPUSDT", "XRP", "XRP", "Payments", 6),
    ("DOGEUSDT", "Dogecoin", "DOGE", "Meme", 7),
    ("AVAXUSDT", "Avalanche", "AVAX", "Layer 1", 8),
]

#: Model inputs, in coefficient order.
FEATURES = [
    "return_1",
    "return_2",
    "price_to_ma5",
    "price_to_ma20",
    "volatility_5",
    "volatility_10",
    "volume_ratio",
    "rsi",
    "price_range",
    "body_size",
]

#: Source tag a rollup job writes next to its candles.
SOURCE_TAG = {interval: f"spark_{interval}_aggregator" for interval in ("5m", "1h", "4h", "1d")}

#: Rollup chain: each interval is built from the one before it.
CASCADE = ["1m", "5m", "1h", "4h", "1d"]

#: Time to live per table in seconds.
TTL_SECONDS = {
    "candles_1m": 86_400,
    "candles_5m": 604_800,
    "book": 3_600,
    "trades": 86_400,
    "predictions": 86_400,
    "latest_prediction": 1_800,
    "synced_prediction": 300,
    "ticker": 120,
    "book_top": 30,
}

#: Lateness accepted per stream kind.
LATENESS = {"trades": "10 minutes", "klines": "5 minutes", "book": "1 minute"}

#: Micro-batch cadence per query.
TRIGGER = {"ohlcv": "10 seconds", "klines": "5 seconds", "book": "2 seconds", "ranking": "5 seconds"}

#: Record ceiling of one trade micro-batch.
MAX_TRADES_PER_TRIGGER = 50_000

#: Training history in days, smallest training set, bars fetched for scoring.
TRAINING_DAYS = 30
MIN_TRAINING_ROWS = 100
LOOKBACK_BARS = 40

#: Pair discovery: quote asset, smallest 24 h quote volume, most pairs.
QUOTE_ASSET = "USDT"
MIN_PAIR_VOLUME = 500_000_000.0
MAX_PAIRS = 20

#: Book levels kept by the normaliser and shown by the depth views.
BOOK_LEVELS = 20
DISPLAY_LEVELS = 15

#: Newest trades kept per symbol.
RECENT_TRADES = 100

#: Sentiment bands: lowest score of each label, best first.
SENTIMENT_BANDS = [(70, "Greed"), (55, "Bullish"), (45, "Neutral"), (30, "Bearish")]
SENTIMENT_FLOOR = "Fear"

#: Confidence bands: lowest display share of each.
CONFIDENCE_BANDS = [(70, "high"), (45, "medium")]
CONFIDENCE_FLOOR = "low"
