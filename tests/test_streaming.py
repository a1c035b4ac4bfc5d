import json
import os

import pytest
from conftest import rows_of

from tapewright.schemas import TRADE
from tapewright.session import stream_session
from tapewright.sources.decode import decode_json
from tapewright.sources.sinks import CandleTable, read_latest
from tapewright.sources.streams import read_files
from tapewright.streaming import jobs
from tapewright.streaming.supervise import ProgressLog, await_all, supervise

MINUTE = 60_000
START = 1_704_067_200_000

#: One file per micro-batch; rows are (trade id, minute, price).
LATE = [
    [(1, 0, 10), (2, 2, 11)],
    [(3, 30, 12)],
    [(4, 1, 99), (5, 20.5, 50), (6, 31, 13)],
    [(7, 19, 77), (8, 32, 14)],
]


def write_file(folder, number, rows, symbol="A"):
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number}.txt"
    lines = [
        json.dumps(
            {"symbol": symbol, "trade_id": i, "price": float(p), "quantity": 1.0, "trade_time": START + int(m * MINUTE), "is_buyer_maker": True}
        )
        for i, m, p in rows
    ]
    path.write_text("\n".join(lines))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def trade_stream(spark, folder, max_files=1):
    return decode_json(read_files(stream_session(spark, 2), str(folder), max_files=max_files), TRADE)


@pytest.fixture
def late_files(tmp_path):
    for number, rows in enumerate(LATE):
        write_file(tmp_path / "in", number, rows)
    return tmp_path / "in"


@pytest.mark.parametrize(
    ("interval", "dropped", "expected"),
    [
        ("5m", 1, [(0, 10.0, 11.0, 3), (20, 50.0, 50.0, 1), (30, 12.0, 14.0, 3)]),
        ("1h", 0, [(0, 10.0, 14.0, 8)]),
    ],
)
def test_late_trades(spark, tmp_path, late_files, interval, dropped, expected):
    table = CandleTable(str(tmp_path / "candles"))
    stream = trade_stream(spark, late_files)
    log = ProgressLog(stream.sparkSession)
    query = jobs.start_ohlcv(stream, interval, table, str(tmp_path / "cp"), every=None)
    await_all([query])
    got = [((r.open_time - START) // MINUTE, r.open, r.close, r.trades) for r in table.read(spark).orderBy("open_time").collect()]
    assert got == expected
    assert log.close([query]).agg({"dropped_late": "sum"}).collect()[0][0] == dropped


def test_restart_continues_and_updates_stored_candles(spark, tmp_path):
    table, folder, checkpoint = CandleTable(str(tmp_path / "candles")), tmp_path / "in", str(tmp_path / "cp")
    write_file(folder, 0, [(1, 0, 10)])
    await_all([jobs.start_ohlcv(trade_stream(spark, folder), "5m", table, checkpoint, every=None)])
    write_file(folder, 1, [(2, 1, 12)])
    await_all([jobs.start_ohlcv(trade_stream(spark, folder), "5m", table, checkpoint, every=None)])
    assert rows_of(table.read(spark), "open", "close", "trades") == [(10.0, 12.0, 2)]


def test_ranking_is_replaced_each_batch(spark, tmp_path):
    folder = tmp_path / "in"
    write_file(folder, 0, [(1, 0, 10), (2, 1, 20)], "A")
    write_file(folder, 1, [(3, 0, 10), (4, 1, 40)], "B")
    write_file(folder, 2, [(5, 2, 5)], "A")
    path = str(tmp_path / "ranking")
    await_all([jobs.start_ranking(trade_stream(spark, folder), path, str(tmp_path / "cp"), None)])
    assert rows_of(read_latest(spark, path), "symbol", "price", "percent_change") == [("A", 5.0, -50.0), ("B", 40.0, 300.0)]


def test_a_failing_write_fails_the_query(spark, tmp_path, late_files):
    def broken(batch, batch_id):
        raise ValueError("sink is down")

    query = jobs.run(trade_stream(spark, late_files), "broken", "append", broken, str(tmp_path / "cp"), None)
    good = jobs.start_append(trade_stream(spark, late_files), "good", str(tmp_path / "out"), str(tmp_path / "cp"))
    with pytest.raises(Exception, match="sink is down"):
        supervise(spark, [query, good], poll_seconds=1)
    assert not query.isActive and not good.isActive


def test_a_new_checkpoint_does_not_take_over_old_staged_rows(spark, tmp_path):
    table, folder = CandleTable(str(tmp_path / "candles")), tmp_path / "in"
    write_file(folder, 0, [(1, 0, 10)])
    await_all([jobs.start_ohlcv(trade_stream(spark, folder), "5m", table, str(tmp_path / "cp1"), every=None)])
    write_file(folder, 1, [(2, 1, 12)])
    await_all([jobs.start_ohlcv(trade_stream(spark, folder, None), "5m", table, str(tmp_path / "cp2"), every=None)])
    assert rows_of(table.read(spark), "close", "trades") == [(12.0, 2)]


def test_progress_of_more_batches_than_a_query_remembers(spark, tmp_path):
    for number in range(105):
        write_file(tmp_path / "in", number, [(number, 0, 1)])
    streaming = stream_session(spark, 1)
    log = ProgressLog(streaming, str(tmp_path / "log"), flush=40)
    stream = decode_json(read_files(streaming, str(tmp_path / "in"), max_files=1), TRADE)
    query = jobs.start_append(stream, "many", str(tmp_path / "out"), str(tmp_path / "cp"))
    await_all([query])
    got = log.close([query]).where("query = 'many'").agg({"input_rows": "sum", "output_rows": "sum"}).collect()[0]
    assert tuple(got) == (105, 105)


def test_exchange_candles_need_an_order(spark, tmp_path, late_files):
    with pytest.raises(ValueError, match="order"):
        jobs.start_klines(trade_stream(spark, late_files), CandleTable(str(tmp_path / "t")), str(tmp_path / "cp"))
