"""Market-data inputs derived from the ``events`` table.

An event is read as a trade: its type is the symbol, its value the price, the number in
its properties the quantity, and an even user sold. Everything else the queries need
(candles, books, tickers, predictions, messages) is computed from these trades.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators import candles, features
from tapewright.plans import forecast
from tapewright.schemas import WIDTH_MS
from tapewright.session import materialize, scratch_path, stream_session, use_utc
from tapewright.sources import tables

#: Explicit clock of the queries: 2024-01-30T18:42:30Z. Later bars count as open.
AS_OF = 1_706_640_150_000

#: 2024-01-01T00:00:00Z, when the events begin.
FIRST_DAY = 1_704_067_200_000

#: The clock a day earlier.
EARLIER = AS_OF - WIDTH_MS["1d"]

#: Days of one fit of the sliding refit.
SPAN_DAYS = 10

#: Four of the five symbols, so that one has no metadata.
DIM_ROWS = [
    ("click", "Click", "CLK", "Layer 1", 1),
    ("error", "Error", "ERR", "Exchange", 2),
    ("purchase", "Purchase", "PUR", "Payments", 3),
    ("view", "View", "VIW", "Meme", 4),
]

#: Fixed model parameters, so that scores can be written out in SQL.
PARAMS = {
    "model_type": "LinearRegression",
    "features": features.FEATURES,
    "intercept": 0.25,
    "coefficients": {
        "return_1": -0.5,
        "return_2": 0.125,
        "price_to_ma5": -0.75,
        "price_to_ma20": 0.375,
        "volatility_5": 0.0625,
        "volatility_10": -0.25,
        "volume_ratio": 0.5,
        "rsi": -1.5,
        "price_range": 0.25,
        "body_size": -0.125,
    },
    "scaler_mean": {
        "return_1": 100.0,
        "return_2": 100.0,
        "price_to_ma5": 0.5,
        "price_to_ma20": 0.25,
        "volatility_5": 30.0,
        "volatility_10": 35.0,
        "volume_ratio": 1.0,
        "rsi": 75.0,
        "price_range": 40.0,
    },
    "scaler_std": {
        "return_1": 400.0,
        "return_2": 400.0,
        "price_to_ma5": 64.0,
        "price_to_ma20": 80.0,
        "volatility_5": 16.0,
        "volatility_10": 16.0,
        "volume_ratio": 0.5,
        "rsi": 16.0,
        "price_range": 32.0,
        "body_size": 0.0,
    },
}


#: Layout of the ``events`` table; giving it saves reading file footers to plan a query.
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

#: The number in an event's ``{"k": <number>}`` properties.
QUANTITY_PATTERN = r'"k":\s*(\d+)'


class Inputs:
    """Inputs of one query run: a session and a folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder
        self._bars: dict[str, DataFrame] = {}

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(f"{self.folder}/events.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def stream_spark(self) -> SparkSession:
        return stream_session(self.spark)

    # --- trades ---

    @cached_property
    def tape(self) -> DataFrame:
        time = F.unix_millis(F.col("ts").cast("timestamp"))
        return self.events.select(
            F.col("event_type").alias("symbol"),
            F.col("event_id").alias("trade_id"),
            F.col("value").alias("price"),
            F.regexp_extract("props", QUANTITY_PATTERN, 1).cast("double").alias("quantity"),
            time.alias("trade_time"),
            (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        """The tape in the full trade layout."""
        return self.tape.withColumns(
            {
                "is_best_match": F.lit(True),
                "event_time": F.col("trade_time"),
                "ingestion_time": F.col("trade_time"),
            }
        )

    @property
    def dim(self) -> DataFrame:
        return tables.symbol_metadata(self.spark, DIM_ROWS)

    # --- candles ---

    def bars(self, interval: str) -> DataFrame:
        if interval not in self._bars:
            self._bars[interval] = candles.ohlcv(self.tape, interval)
        return self._bars[interval]

    @property
    def candle_table(self) -> DataFrame:
        """Stored candles of three intervals with their partition date."""
        bars = self.bars("5m").unionByName(self.bars("1h")).unionByName(self.bars("4h"))
        return bars.withColumn("date", tables.partition_date(F.col("interval"), F.col("open_time")))

    def klines(self, *intervals: str) -> DataFrame:
        """Exchange candles; those not closed at the clock are still open."""
        rows = None
        for interval in intervals or ("1m", "5m"):
            bars = candles.mark_closed(self.bars(interval), AS_OF).select(
                *(c for c in candles.BAR_COLUMNS if c not in ("trades", "vwap")),
                F.col("trades").cast("int").alias("trades_count"),
                "is_closed",
                F.col("close_time").alias("event_time"),
                F.col("close_time").alias("ingestion_time"),
            )
            rows = bars if rows is None else rows.unionByName(bars)
        return rows

    # --- features and predictions ---

    def features(self, interval: str = "1h") -> DataFrame:
        return features.features(self.bars(interval), interval)

    @property
    def training(self) -> DataFrame:
        return features.clean(self.features()).select("symbol", "open_time", "close", "target", *features.FEATURES)

    @property
    def predictions(self) -> DataFrame:
        """A prediction for every complete hourly bar, made when the bar closed."""
        made = forecast.iso_time(F.col("open_time") + WIDTH_MS["1h"])
        return forecast.predictions(features.clean(self.features(), None), PARAMS, made, "1h")

    # --- books ---

    @property
    def depth_feed(self) -> DataFrame:
        """One depth message per symbol and hour, at its end: all levels of each side as strings,
        the quantities of one price added up. A side without trades is empty."""
        levels = self.tape.select(
            "symbol",
            (F.col("trade_time") - F.pmod("trade_time", F.lit(WIDTH_MS["1h"])) + WIDTH_MS["1h"]).alias("timestamp"),
            F.when(F.col("is_buyer_maker"), "bid").otherwise("ask").alias("side"),
            F.when(F.col("is_buyer_maker"), 1000 - F.col("price")).otherwise(1000 + F.col("price")).alias("price"),
            "quantity",
        )
        summed = levels.groupBy("symbol", "timestamp", "side", "price").agg(F.sum("quantity").alias("quantity"))
        return summed.groupBy("symbol", "timestamp").agg(_side("bid").alias("bids"), _side("ask").alias("asks"))

    @property
    def depth_messages(self) -> DataFrame:
        """Depth messages in their stream envelope."""
        data = F.struct("bids", "asks")
        stream = F.concat(F.lower("symbol"), F.lit("@depth20"))
        return self.depth_feed.select(
            F.to_json(F.struct(stream.alias("stream"), data.alias("data"))).alias("value"), "timestamp"
        )

    @property
    def books(self) -> DataFrame:
        from tapewright.sources.decode import normalize_depth

        feed = self.depth_feed.withColumn("value", F.to_json(F.struct("bids", "asks")))
        books = normalize_depth(feed, F.col("symbol"), F.col("timestamp"), levels=None)
        return books.withColumn("symbol", F.lower("symbol"))

    @property
    def quotes(self) -> DataFrame:
        """A top-of-book update per trade, stamped with its hour, so stamps repeat."""
        return self.tape.select(
            "symbol",
            (1000 - F.col("price")).alias("best_bid"),
            (1000 + F.col("price")).alias("best_ask"),
            (2 * F.col("price")).alias("spread"),
            (F.col("trade_time") - F.pmod("trade_time", F.lit(WIDTH_MS["1h"]))).alias("timestamp"),
            "trade_time",
            "trade_id",
        )

    # --- raw messages ---

    @property
    def trade_messages(self) -> DataFrame:
        """Exchange trade messages; those without quantity arrive cut short."""
        record = F.struct(
            F.lit("trade").alias("e"),
            F.col("trade_time").alias("E"),
            F.col("symbol").alias("s"),
            F.col("trade_id").alias("t"),
            F.col("price").cast("string").alias("p"),
            F.col("quantity").cast("string").alias("q"),
            F.col("trade_time").alias("T"),
            F.col("is_buyer_maker").alias("m"),
            F.when(F.col("is_buyer_maker"), F.lit(True)).alias("M"),
        )
        text = F.to_json(record)
        return self.tape.select(
            F.when(F.col("quantity") > 0, text).otherwise(F.substring(text, 1, 12)).alias("value"), "trade_time"
        )

    def kline_messages(self, interval: str = "1h") -> DataFrame:
        def text(name: str) -> Column:
            return F.col(name).cast("string")

        k = F.struct(
            F.col("symbol").alias("s"),
            F.col("interval").alias("i"),
            F.col("open_time").alias("t"),
            F.col("close_time").alias("T"),
            text("open").alias("o"),
            text("high").alias("h"),
            text("low").alias("l"),
            text("close").alias("c"),
            text("volume").alias("v"),
            text("quote_volume").alias("q"),
            F.col("trades_count").alias("n"),
            text("taker_buy_volume").alias("V"),
            F.col("is_closed").alias("x"),
        )
        record = F.struct(F.lit("kline").alias("e"), F.col("event_time").alias("E"), k.alias("k"))
        return self.klines(interval).select(F.to_json(record).alias("value"))

    # --- tickers ---

    def tickers(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """A pair per user with its traded volume as text; the ``error`` traders' own
        pairs report no number."""
        trades = self.events.select(
            "user_id",
            "event_type",
            F.col("value").alias("price"),
            F.regexp_extract("props", QUANTITY_PATTERN, 1).cast("double").alias("quantity"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("trade_time"),
        )
        if start is not None:
            trades = trades.where(F.col("trade_time") >= start)
        if end is not None:
            trades = trades.where(F.col("trade_time") < end)
        quote = F.when(F.col("user_id") % 2 == 0, "USDT").otherwise("BTC")
        volume = F.sum((F.col("price") * F.col("quantity")).cast("decimal(18,2)")).cast("decimal(18,2)")
        per_user = trades.groupBy("user_id").agg(
            volume.alias("volume"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count("*").alias("n")
        )
        return per_user.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string"), quote).alias("symbol"),
            F.when(F.col("errors") * 4 > F.col("n"), F.lit("n/a"))
            .otherwise(F.col("volume").cast("string"))
            .alias("quote_volume"),
        )

    # --- streams ---

    def as_files(self, messages: DataFrame, name: str) -> str:
        """Message texts stored as files a stream can read."""
        path = self.scratch(name)
        messages.select("value").write.text(path)
        return path

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name)


def _side(name: str) -> Column:
    """Levels of one side, best first, as ``[price, quantity]`` strings."""
    pair = F.array(F.col("price").cast("string"), F.col("quantity").cast("string")).alias("pair")
    level = F.struct(F.abs(F.col("price") - 1000).alias("distance"), pair)
    sorted_levels = F.array_sort(F.collect_list(F.when(F.col("side") == name, level)))
    return F.transform(sorted_levels, lambda s: s["pair"])
