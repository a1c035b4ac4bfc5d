"""Streams with state: several micro-batches, restarts, late rows, and what the state forgets."""

import json
import os

import pytest
from conftest import rows_of

from tapewright.operators import features as batch_features
from tapewright.operators.state import recent_trades
from tapewright.schemas import BOOK_TOP, CANDLE, PREDICTION, TRADE
from tapewright.session import stream_session
from tapewright.sources.decode import decode_json
from tapewright.sources.sinks import CandleTable
from tapewright.sources.streams import read_files
from tapewright.streaming import jobs, stateful
from tapewright.streaming.supervise import ProgressLog, await_all

MINUTE, HOUR = 60_000, 3_600_000
START = 1_704_067_200_000


class Feed:
    """JSON files that a stream reads one after the other."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.number = spark, folder, schema, 0
        folder.mkdir()

    def add(self, *rows):
        path = self.folder / f"part-{self.number}.txt"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (1_700_000_000 + self.number, 1_700_000_000 + self.number))
        self.number += 1
        return self

    def stream(self):
        return decode_json(read_files(stream_session(self.spark, 2), str(self.folder), max_files=1), self.schema)


def trade(symbol, ident, minute, price=1.0, **more):
    return {"symbol": symbol, "trade_id": ident, "price": price, "quantity": 1.0, "trade_time": START + int(minute * MINUTE), "is_buyer_maker": True, **more}


@pytest.fixture
def feed(spark, tmp_path):
    made = []

    def make(schema):
        made.append(Feed(spark, tmp_path / f"in{len(made)}", schema))
        return made[-1]

    return make


# --- recent trades ---


def test_recent_trades_over_batches_and_a_restart(spark, tmp_path, feed):
    messages = feed(TRADE)
    table, checkpoint = stateful.recent_table(str(tmp_path / "recent")), str(tmp_path / "cp")
    big = 2**62
    rows = [
        [trade("A", k, k % 7, price=float(k)) for k in range(12)] + [trade("B", big + 1, 5)],
        [trade("A", k, k % 7, price=float(k)) for k in range(6, 20)] + [trade("B", big + 1, 5), trade("B", big, 5, is_buyer_maker=None)],
        [trade("A", 3, 99), trade("C", None, 1, price=None), trade("C", 1, 1)],
        [trade("A", 90, 0.5)],  # older than all that are kept
    ]
    for part in (rows[:2], rows[2:]):
        for batch in part:
            messages.add(*batch)
        await_all([stateful.start_recent_trades(messages.stream(), table, checkpoint, None, keep=5)])
    columns = ["symbol", "trade_time", "trade_id", "price", "quantity", "is_buyer_maker"]
    every = spark.createDataFrame([tuple(r[c] for c in columns) for b in rows for r in b], "symbol string, trade_time bigint, trade_id bigint, price double, quantity double, is_buyer_maker boolean")
    got, want = table.read(spark), recent_trades(every, 5)
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    newest = got.where("symbol = 'A'").orderBy("position").collect()
    assert [r.position for r in newest] == [1, 2, 3, 4, 5] and [r.trade_time for r in newest] == sorted((r.trade_time for r in newest), reverse=True)


def test_a_batch_that_changes_no_list_writes_nothing(spark, tmp_path, feed):
    messages = feed(TRADE).add(*[trade("A", k, k) for k in range(9)]).add(trade("A", 0, 0), trade("A", 8, 8))
    stream = messages.stream()
    log = ProgressLog(stream.sparkSession)
    query = stateful.start_recent_trades(stream, stateful.recent_table(str(tmp_path / "t")), str(tmp_path / "cp"), None, keep=3)
    await_all([query])
    written = [r.output_rows for r in log.close([query]).where("input_rows > 0").orderBy("batch_id").collect()]
    assert written == [3, 0]


# --- forecasts ---


def test_forecasts_wait_for_their_bar_and_come_out_without_it(spark, tmp_path, feed):
    made, bars = feed(PREDICTION), feed(CANDLE)

    def forecast(hour, symbol="A"):
        return {"symbol": symbol, "open_time": START + hour * HOUR, "close": 100.0, "predicted_price": 110.0}

    def bar(hour, close, symbol="A"):
        return {"symbol": symbol, "interval": "1h", "open_time": START + hour * HOUR, "close": close}

    made.add(forecast(0), forecast(1), forecast(2), forecast(0, "B")).add(forecast(9), forecast(10))
    bars.add(bar(1, 120.0), bar(1, 55.0) | {"interval": "4h"}).add(bar(3, 100.0), bar(10, 0.0), bar(9, 1.0, "C"))
    table = stateful.realised_table(str(tmp_path / "t"))
    await_all([stateful.start_actuals(made.stream(), bars.stream(), table, str(tmp_path / "cp"), "1h", None, "5 minutes")])
    got = {(r.symbol, (r.open_time - START) // HOUR): (r.actual_price, r.actual_change, r.accuracy) for r in table.read(spark).collect()}
    assert got.pop(("A", 0)) == (120.0, 20.0, pytest.approx(100 - 100 / 12))
    assert got.pop(("A", 2)) == (100.0, 0.0, 90.0)
    assert got.pop(("A", 9)) == (0.0, -100.0, None)
    # The bars of 2 h never came, and that of 11 h may still come.
    assert got == {("A", 1): (None, None, None), ("B", 0): (None, None, None)}


# --- cascade ---


def test_cascade_gives_final_candles_once_and_drops_what_comes_too_late(spark, tmp_path, feed):
    messages = feed(TRADE)
    messages.add(trade("A", 1, 0, 10.0), trade("A", 2, 59, 12.0), trade("A", 3, 61, 20.0))
    messages.add(trade("A", 4, 200, 30.0))
    messages.add(trade("A", 5, 300, 31.0))
    messages.add(trade("A", 6, 30, 99.0), trade("A", 7, 250, 25.0), trade("A", 8, 301, 32.0))
    table = CandleTable(str(tmp_path / "candles"))
    stream = messages.stream()
    log = ProgressLog(stream.sparkSession)
    query = stateful.start_cascade(stream, "1h", table, str(tmp_path / "cp"), None, "60 minutes")
    await_all([query])
    got = [((r.open_time - START) // HOUR, r.open, r.high, r.low, r.close, r.trades) for r in table.read(spark).orderBy("open_time").collect()]
    assert got == [(0, 10.0, 12.0, 10.0, 12.0, 2), (1, 20.0, 20.0, 20.0, 20.0, 1), (3, 30.0, 30.0, 30.0, 30.0, 1)]
    progress = log.close([query]).agg({"dropped_late": "sum", "output_rows": "sum"}).collect()[0]
    assert (progress["sum(dropped_late)"], progress["sum(output_rows)"]) == (1, 3)


# --- snapshots ---


def test_repeated_snapshots_within_the_bound(spark, tmp_path, feed):
    def top(minute, symbol="A", bid=1.0):
        return {"symbol": symbol, "best_bid": bid, "best_ask": 2.0, "spread": 1.0, "timestamp": START + minute * MINUTE}

    messages = feed(BOOK_TOP).add(top(0), top(0), top(0, "B")).add(top(1), top(0)).add(top(90)).add(top(91), top(1))
    path = str(tmp_path / "out")
    stream = messages.stream()
    log = ProgressLog(stream.sparkSession)
    query = jobs.start_append(stateful.dedupe(stream, "10 minutes"), "books", path, str(tmp_path / "cp"))
    await_all([query])
    got = rows_of(spark.read.parquet(path), "symbol", "timestamp")
    assert got == [("A", START), ("A", START + MINUTE), ("A", START + 90 * MINUTE), ("A", START + 91 * MINUTE), ("B", START)]
    assert log.close([query]).orderBy("batch_id", ascending=False).first().state_rows <= 2


# --- features ---


def test_features_over_batches_equal_the_window(spark, tmp_path, bars, feed):
    closes = {"A": [100 + (k * 37 % 11) - k % 3 for k in range(47)], "B": [5.0, 5.0], "C": [7.0] * 23}
    table = bars(closes, volume=2.0)
    rows = sorted((r.asDict() for r in table.collect()), key=lambda r: r["open_time"])
    messages = feed(CANDLE)
    for k in range(0, len(rows), 9):
        messages.add(*reversed(rows[k : k + 9]), *rows[max(0, k - 4) : k])  # unordered, with repeats
    messages.add({**rows[0], "open_time": rows[0]["open_time"] + 1})  # not newer than what was seen
    path = str(tmp_path / "out")
    await_all([jobs.start_append(stateful.features(messages.stream()), "features", path, str(tmp_path / "cp"))])
    names = list(stateful.FEATURE_COLUMNS)
    want = {(r.symbol, r.open_time): r for r in batch_features.features(table).collect()}
    got = {(r.symbol, r.open_time): r for r in spark.read.parquet(path).collect()}
    assert got.keys() == want.keys()
    for key, row in got.items():
        for name in names:
            expected = want[key][name]
            assert row[name] == (None if expected is None else pytest.approx(expected, abs=1e-9)), (key, name)


# --- expiry ---


def test_rows_expire_by_timers(spark, tmp_path, feed):
    def row(symbol, minute, close):
        return {"symbol": symbol, "open_time": START + minute * MINUTE, "close": close}

    messages = feed(PREDICTION)
    messages.add(row("A", 0, 1.0), row("B", 0, 1.0))
    messages.add(row("A", 20, 2.0), row("A", 10, 1.5))
    messages.add(row("C", 45, 3.0))  # B is over at 30, A at 50
    messages.add(row("B", 46, 4.0))
    messages.add(row("D", 60, 5.0))
    from pyspark.sql import functions as F

    values = {"close": "double"}
    table = stateful.expiring_table(str(tmp_path / "t"), values)
    await_all([stateful.start_expiring(messages.stream(), values, F.col("open_time"), table, str(tmp_path / "cp"), 1800, None)])
    assert rows_of(stateful.hot_rows(table, spark), "symbol", "close") == [("B", 4.0), ("C", 3.0), ("D", 5.0)]
    assert rows_of(table.read(spark), "symbol", "close", "live") == [("A", 2.0, False), ("B", 4.0, True), ("C", 3.0, True), ("D", 5.0, True)]
