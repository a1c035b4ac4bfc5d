import json

from conftest import rows_of
from pyspark.sql import functions as F

from tapewright.functions import symbols
from tapewright.operators import book as op
from tapewright.schemas import CANDLE, TRADE
from tapewright.sources import decode, streams


def messages(spark, *values):
    texts = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(texts, "value STRING")


TRADE_MESSAGE = {"e": "trade", "E": 5, "s": "AUSDT", "t": 7, "p": "1.5", "q": "2", "T": 4, "m": True, "M": True}
KLINE_MESSAGE = {
    "e": "kline",
    "E": 9,
    "k": {"s": "AUSDT", "i": "1m", "t": 0, "T": 59999, "o": "1", "h": "4", "l": "0.5", "c": "2", "v": "10", "q": "15", "n": 3, "V": "6", "x": True},
}


def test_broken_records_are_quarantined(spark):
    good = json.dumps({"symbol": "A", "price": 1.0})
    partly = json.dumps({"symbol": "B", "price": "abc"})
    df = messages(spark, good, partly, "{bad", "")
    assert rows_of(decode.decode_json(df, TRADE), "symbol", "price") == [("A", 1.0), ("B", None)]
    assert rows_of(decode.quarantine(df, TRADE), "value") == [("",), ("{bad",)]


def test_normalize_trade(spark):
    plain = {k: v for k, v in TRADE_MESSAGE.items() if k != "M"}
    df = messages(spark, TRADE_MESSAGE, {**plain, "t": 8, "p": "x"}, KLINE_MESSAGE, "{bad")
    got = rows_of(decode.normalize_trade(df), "trade_id", "symbol", "price", "trade_time", "event_time", "is_best_match")
    assert got == [(7, "AUSDT", 1.5, 4, 5, True), (8, "AUSDT", None, 4, 5, False)]


def test_normalize_kline(spark):
    row = decode.normalize_kline(messages(spark, KLINE_MESSAGE, TRADE_MESSAGE)).collect()
    assert len(row) == 1
    k = row[0]
    assert (k.open_time, k.close_time, k.open, k.high, k.close, k.trades_count, k.taker_buy_volume, k.is_closed) == (
        *(0, 59999, 1.0, 4.0, 2.0, 3, 6.0, True),
    )


def test_depth_levels_and_empty_sides(spark):
    full = {"bids": [["10", "1"], ["9", "2"], ["x", "3"], ["8"], ["7", "4"]], "asks": [["11", "5"]]}
    one_sided = {"bids": [["10", "1"]], "asks": []}
    df = messages(spark, full, one_sided)
    books = decode.normalize_depth(df, F.lit("ausdt"), F.length("value").cast("bigint"), levels=4)
    rows = books.orderBy(F.size("bids").desc()).collect()
    assert [tuple(lv) for lv in rows[0].bids] == [(10.0, 1.0), (9.0, 2.0)]
    assert (rows[0].symbol, rows[0].best_bid, rows[0].best_ask, rows[0].spread, rows[0].spread_valid) == ("AUSDT", 10.0, 11.0, 1.0, True)
    assert (rows[1].best_ask, rows[1].spread, rows[1].spread_valid) == (0.0, 0.0, False)


def test_routing(spark):
    depth = {"stream": "ausdt@depth20@100ms", "data": {"bids": [], "asks": []}}
    df = messages(spark, {"stream": "ausdt@trade", "data": TRADE_MESSAGE}, TRADE_MESSAGE, KLINE_MESSAGE, depth, {"e": "other"}, "{bad")
    routed = decode.route_messages(df)
    counts = {r.kind: r["count"] for r in routed.groupBy("kind").count().collect()}
    assert counts == {"trade": 2, "kline": 1, "depth": 1, None: 2}
    assert rows_of(routed.where("kind = 'depth'"), "stream_symbol") == [("AUSDT",)]
    assert decode.normalize_trade(routed, "payload").count() == 2


def test_symbol_interval_filter(spark):
    df = spark.createDataFrame([("A", "1m"), ("A", "5m"), ("A", None), ("A", ""), ("B", "1m")], "symbol STRING, interval STRING")
    assert decode.symbol_interval_filter(df, "A", "1m").count() == 3
    assert decode.symbol_interval_filter(df, "A").count() == 4


def test_alias_coalesce_reads_both_styles(spark):
    short = {"s": "A", "i": "5m", "t": 1, "T": 2, "o": "3", "x": True}
    long = {"symbol": "B", "open_time": 5, "close_time": 6, "open": 7.0, "trades_count": 2, "is_closed": False}
    got = rows_of(
        decode.alias_coalesce(messages(spark, short, long)),
        *("symbol", "interval", "open_time", "close_time", "open", "volume", "trades_count", "is_closed"),
    )
    assert got == [("A", "5m", 1, 2, 3.0, 0.0, 0, True), ("B", "1m", 5, 6, 7.0, 0.0, 2, False)]


def test_update_tag(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "is_closed BOOLEAN")
    assert sorted(r.type for r in decode.tag_update(df).collect()) == ["realtime", "update", "update"]


def test_normalize_types(spark):
    df = spark.createDataFrame([("A", "12", "bad")], "symbol STRING, open_time STRING, open STRING")
    row = decode.normalize_types(df, CANDLE).collect()[0]
    assert (row.symbol, row.open_time, row.open, row.volume) == ("A", 12, None, None)


def test_broker_options():
    options = streams.broker_options("host:9092", "trades", 50_000)
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "trades",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "50000",
    }


def test_symbol_strings(spark):
    df = spark.createDataFrame([("AUSDT",), ("USDTB",)], "symbol STRING")
    got = rows_of(df.select(symbols.base_asset(F.col("symbol"), "USDT").alias("b"), symbols.quoted_in(F.col("symbol"), "USDT").alias("q")), "b", "q")
    assert got == [("A", True), ("USDTB", False)]


def _book(spark, bids, asks):
    return spark.createDataFrame(
        [("A", 1, bids, asks)],
        "symbol STRING, timestamp BIGINT, bids ARRAY<STRUCT<price: DOUBLE, quantity: DOUBLE>>, "
        "asks ARRAY<STRUCT<price: DOUBLE, quantity: DOUBLE>>",
    )


def test_book_views(spark):
    book = _book(spark, [(10.0, 3.0), (9.0, None), (8.0, 1.0)], [(11.0, 4.0)])
    got = rows_of(op.cumulative(book), "side", "level", "price", "total")
    assert got == [("ask", 1, 11.0, 44.0), ("bid", 1, 10.0, 30.0), ("bid", 2, 8.0, 38.0)]
    assert rows_of(op.cumulative(book, 1), "side", "total") == [("ask", 44.0), ("bid", 30.0)]
    assert op.imbalance(book).collect()[0].bid_pct == 50.0
    assert op.imbalance(book, 1).collect()[0].bid_pct == 300 / 7
    assert rows_of(op.depth_norm(book), "side", "level", "depth_pct") == [("ask", 1, 100.0), ("bid", 1, 75.0), ("bid", 2, 0.0), ("bid", 3, 25.0)]
    empty = op.imbalance(_book(spark, [], [])).collect()[0]
    assert (empty.bid_quantity, empty.bid_pct) == (0.0, 50.0)


def test_dedupe_keeps_changes_only(spark):
    stamps = [5, 5, 6, 5, 5, 7]
    df = spark.createDataFrame([("A", s, k * 10) for k, s in enumerate(stamps)], "symbol STRING, timestamp BIGINT, seen BIGINT")
    for block_ms in (1, 25, 1000):
        assert [r[0] for r in rows_of(op.dedupe(df, ("seen",), block_ms), "seen")] == [0, 20, 30, 50]
