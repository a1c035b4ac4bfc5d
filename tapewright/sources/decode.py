"""JSON messages to typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions import book
from tapewright.functions.symbols import stream_symbol
from tapewright.schemas import (
    BOOK_LEVELS,
    RAW_DEPTH,
    RAW_KLINE,
    RAW_KLINE_NAMES,
    RAW_TRADE,
    RAW_TRADE_NAMES,
)


def parse_once(df: DataFrame, record: Column, name: str) -> DataFrame:
    """Add ``record`` as a column that is computed exactly once per row.

    A projected ``from_json`` is copied into every later filter and field access; the
    output of a generator is not.
    """
    return df.withColumn(name, F.explode(F.array(record)))


def decode_json(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Decode a JSON column into the columns of ``schema``.

    A bad field becomes NULL; a record with no readable field gives no row and is
    found by ``quarantine``.
    """
    parsed = parse_once(messages, F.from_json(F.col(value).cast("string"), schema), "_m")
    return parsed.where(~_unreadable("_m", schema)).select("_m.*")


def quarantine(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The records ``decode_json`` leaves out, unchanged."""
    parsed = parse_once(messages, F.from_json(F.col(value).cast("string"), schema), "_m")
    return parsed.where(_unreadable("_m", schema)).drop("_m")


def _unreadable(record: str, schema: T.StructType) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{record}.{name}").isNull() for name in schema.fieldNames()))


def _record(value: Column, schema: T.StructType, names: str) -> Column:
    return F.from_json(value.cast("string"), schema).cast(names)


def _stamp(time_ms: Column | None) -> Column:
    return (F.lit(None).cast("bigint") if time_ms is None else time_ms).alias("ingestion_time")


def normalize_trade(messages: DataFrame, value: str = "value", ingestion_time: Column | None = None) -> DataFrame:
    """Exchange trade messages to the trade layout; a missing best-match flag is false."""
    raw = parse_once(messages, _record(F.col(value), RAW_TRADE, RAW_TRADE_NAMES), "_r")
    return raw.where("_r.kind = 'trade' AND _r.symbol IS NOT NULL").select(
        "_r.symbol",
        "_r.trade_id",
        F.col("_r.price").try_cast("double").alias("price"),
        F.col("_r.quantity").try_cast("double").alias("quantity"),
        "_r.trade_time",
        "_r.is_buyer_maker",
        F.coalesce("_r.is_best_match", F.lit(False)).alias("is_best_match"),
        "_r.event_time",
        _stamp(ingestion_time),
    )


def normalize_kline(messages: DataFrame, value: str = "value", ingestion_time: Column | None = None) -> DataFrame:
    """Exchange candle messages (nested record) to the kline layout."""
    raw = parse_once(messages, _record(F.col(value), RAW_KLINE, RAW_KLINE_NAMES), "_r")
    numbers = ["open", "high", "low", "close", "volume", "quote_volume"]
    return raw.where("_r.kind = 'kline' AND _r.k.symbol IS NOT NULL").select(
        *(f"_r.k.{c}" for c in ("symbol", "interval", "open_time", "close_time")),
        *(F.col(f"_r.k.{c}").try_cast("double").alias(c) for c in numbers),
        F.col("_r.k.trades_count").try_cast("int").alias("trades_count"),
        F.col("_r.k.taker_buy_volume").try_cast("double").alias("taker_buy_volume"),
        "_r.k.is_closed",
        "_r.event_time",
        _stamp(ingestion_time),
    )


def normalize_depth(
    messages: DataFrame,
    symbol: Column,
    timestamp: Column,
    value: str = "value",
    levels: int | None = BOOK_LEVELS,
) -> DataFrame:
    """Depth messages to the book layout: typed levels, top of book and spread.

    Best prices and spread are 0 for an empty side, with ``spread_valid`` telling a
    true zero spread from a missing one.
    """
    raw = parse_once(messages, F.from_json(F.col(value).cast("string"), RAW_DEPTH), "_d")
    sides = raw.where("_d.bids IS NOT NULL AND _d.asks IS NOT NULL").select(
        F.upper(symbol).alias("symbol"),
        book.parse_levels(F.col("_d.bids"), levels).alias("bids"),
        book.parse_levels(F.col("_d.asks"), levels).alias("asks"),
        timestamp.alias("timestamp"),
    )
    bids, asks = F.col("bids"), F.col("asks")
    return sides.select(
        "symbol",
        "bids",
        "asks",
        book.top_price(bids).alias("best_bid"),
        book.top_price(asks).alias("best_ask"),
        book.spread(bids, asks).alias("spread"),
        "timestamp",
        book.two_sided(bids, asks).alias("spread_valid"),
    )


def route_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Classify raw messages and unwrap their envelope.

    Adds ``kind`` (``kline``, ``trade``, ``depth`` or NULL for anything else, broken
    JSON included), ``payload`` (the inner JSON) and ``stream_symbol`` (depth messages
    carry their symbol only in the stream name).
    """
    raw = F.col(value).cast("string")
    outer = parse_once(messages, F.from_json(raw, "stream STRING, data STRING"), "_o")
    unwrapped = outer.withColumn("payload", F.coalesce("_o.data", raw))
    inner = parse_once(unwrapped, F.from_json("payload", "e STRING, bids STRING, asks STRING"), "_i")
    event = F.col("_i.e")
    has_book = F.col("_i.bids").isNotNull() & F.col("_i.asks").isNotNull()
    return inner.withColumns(
        {
            "stream_symbol": stream_symbol(F.col("_o.stream")),
            "kind": F.when(event.isin("kline", "trade"), event).when(has_book, F.lit("depth")),
        }
    ).drop("_o", "_i")


def symbol_interval_filter(messages: DataFrame, symbol: str, interval: str | None = None) -> DataFrame:
    """Messages of one symbol; with ``interval``, also those that name no interval."""
    kept = messages.where(F.col("symbol") == symbol)
    if interval:
        named = F.nullif(F.col("interval"), F.lit(""))
        kept = kept.where(named.isNull() | (named == interval))
    return kept


def first_of(names: list[str], kind: str, default=None) -> Column:
    """First non-null among alternative field names, converted, else ``default``."""
    return F.coalesce(*(F.col(n).try_cast(kind) for n in names), F.lit(default).cast(kind))


#: Canonical name, accepted names, type, default. Both naming styles occur.
KLINE_ALIASES = [
    ("symbol", ["symbol", "s"], "string", None),
    ("interval", ["interval", "i"], "string", "1m"),
    ("open_time", ["open_time", "t"], "bigint", None),
    ("close_time", ["close_time", "T_"], "bigint", None),
    ("open", ["open", "o"], "double", 0.0),
    ("high", ["high", "h"], "double", 0.0),
    ("low", ["low", "l"], "double", 0.0),
    ("close", ["close", "c"], "double", 0.0),
    ("volume", ["volume", "v"], "double", 0.0),
    ("quote_volume", ["quote_volume", "q"], "double", 0.0),
    ("trades_count", ["trades_count", "n"], "int", 0),
    ("is_closed", ["is_closed", "x"], "boolean", False),
]


def alias_coalesce(messages: DataFrame, value: str = "value") -> DataFrame:
    """Candle messages in either naming style, long names first.

    Long and short names share one schema, so each message is parsed once. The two
    time keys differ only by case; the record is renamed by position.
    """
    longs = [name for _, names, _, _ in KLINE_ALIASES for name in names]
    wire = T.StructType([T.StructField({"T_": "T"}.get(n, n), T.StringType()) for n in longs])
    renamed = T.StructType([T.StructField(n, T.StringType()) for n in longs])
    record = F.from_json(F.col(value).cast("string"), wire).cast(renamed)
    flat = parse_once(messages, record, "_m").select("_m.*")
    return flat.select(*(first_of(names, kind, default).alias(out) for out, names, kind, default in KLINE_ALIASES)).where(
        "symbol IS NOT NULL"
    )


def tag_update(klines: DataFrame) -> DataFrame:
    """Mark each candle message ``update`` (still open) or ``realtime`` (closed)."""
    return klines.withColumn("type", F.when(F.coalesce("is_closed", F.lit(False)), "realtime").otherwise("update"))


def normalize_types(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Loosely typed columns to ``schema``: what does not convert, or is absent, is NULL."""
    present = set(docs.columns)
    return docs.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
