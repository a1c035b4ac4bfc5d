import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tapewright.plans.rollup import roll_last_closed
from tapewright.sources import sinks, tables

SCHEMA = "symbol STRING, interval STRING, open_time BIGINT, close DOUBLE, source STRING"
DAY = 86_400_000


def test_upsert_is_last_write_wins_and_keeps_other_rows(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([("A", "1d", 0, 1.0, "x"), ("B", "1d", 0, 2.0, "x"), ("A", "1d", DAY, 3.0, "x")], SCHEMA))
    change = spark.createDataFrame([("A", "1d", 0, 9.0, "y"), ("C", "1d", 0, 4.0, "y")], SCHEMA)
    for _ in range(2):
        table.upsert(change)
        got = rows_of(table.read(spark), "symbol", "interval", "open_time", "close", "source")
        assert got == [
            ("A", "1d", 0, 9.0, "y"),
            ("A", "1d", DAY, 3.0, "x"),
            ("B", "1d", 0, 2.0, "x"),
            ("C", "1d", 0, 4.0, "y"),
        ]


def test_fields_not_carried_keep_their_value(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([("A", "1m", 0, 1.0, "x")], SCHEMA))
    table.upsert(spark.createDataFrame([("A", "1m", 0, 5.0, True)], "symbol STRING, interval STRING, open_time BIGINT, close DOUBLE, is_closed BOOLEAN"))
    assert rows_of(table.read(spark), "close", "source", "is_closed") == [(5.0, "x", True)]
    with pytest.raises(ValueError, match="surprise"):
        table.upsert(table.read(spark).withColumn("surprise", F.lit(1)))


def test_newest_of_a_batch_wins(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"), ["event_time"])
    rows = [("A", "1m", 0, 1.0, 5), ("A", "1m", 0, 2.0, 7), ("A", "1m", 0, 3.0, 6)]
    table.upsert(spark.createDataFrame(rows, "symbol STRING, interval STRING, open_time BIGINT, close DOUBLE, event_time BIGINT"))
    assert rows_of(table.read(spark), "close") == [(2.0,)]


ORDERED = "symbol STRING, interval STRING, open_time BIGINT, close DOUBLE, event_time BIGINT"


def test_an_older_message_never_replaces_a_newer_one(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"), ["event_time"])
    for close, at in ((1.0, 7), (2.0, 5), (3.0, None)):
        table.upsert(spark.createDataFrame([("A", "1m", 0, close, at)], ORDERED))
        assert rows_of(table.read(spark), "close", "event_time") == [(1.0, 7)]
    table.upsert(spark.createDataFrame([("A", "1m", 0, 4.0, 8)], ORDERED))
    assert rows_of(table.read(spark), "close") == [(4.0,)]


def test_writers_of_one_partition_do_not_undo_each_other(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        one, two = (sinks.CandleTable(str(tmp_path / "t")) for _ in range(2))
        one.upsert(spark.createDataFrame([("A", "1m", 0, 1.0, "w1"), ("B", "1m", 0, 1.0, "w1")], SCHEMA))
        two.upsert(spark.createDataFrame([("A", "1m", 0, 2.0, "w2")], SCHEMA))
        one.upsert(spark.createDataFrame([("A", "1m", DAY, 3.0, "w1")], SCHEMA))
        want = [("A", 0, 2.0), ("A", DAY, 3.0), ("B", 0, 1.0)]
        assert rows_of(one.read(spark), "symbol", "open_time", "close") == want
        one.compact(spark)
        assert rows_of(two.read(spark), "symbol", "open_time", "close") == want
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_an_upsert_reads_nothing_and_writes_its_own_rows(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    table.upsert(spark.range(20_000).selectExpr("concat('S', id) symbol", "'1m' interval", "0L open_time", "1.0D close", "'x' source"))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    table.upsert(spark.createDataFrame([("S1", "1m", 0, 2.0, "y")], SCHEMA))
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert before.items() <= after.items()
    added = [p for p in after if p not in before]
    assert len(added) == 1 and spark.read.parquet(str(added[0])).count() == 1


def test_many_partitions_into_an_existing_table(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    days = spark.range(400).selectExpr("'A' symbol", "'1m' interval", f"id * {DAY} open_time", "1.0D close", "'x' source")
    for _ in range(2):
        table.upsert(days)
    assert table.read(spark).count() == 400


def test_compaction_keeps_what_reads_show(spark, tmp_path, monkeypatch):
    table = sinks.CandleTable(str(tmp_path / "t"), ["event_time"])
    for k in range(4):
        table.upsert(spark.createDataFrame([("A", "1m", 0, float(k), k), (f"S{k}", "1m", k * DAY, 1.0, 1)], ORDERED))
    table.upsert(spark.createDataFrame([("A", "1m", 0, "note")], "symbol STRING, interval STRING, open_time BIGINT, source STRING"))
    show = lambda: rows_of(table.read(spark), "symbol", "open_time", "close", "source")
    want = show()
    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_file", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            table.compact(spark)
    assert show() == want  # cut off between adding and deleting
    assert table.compact(spark, F.col("date") == "1970-01-01") > 1 and show() == want
    table.compact(spark)
    assert show() == want and table.changes(spark).count() == len(want)


def test_compaction_in_rounds(spark, tmp_path, monkeypatch):
    table = sinks.CandleTable(str(tmp_path / "t"), ["event_time"])
    for k in range(3):
        table.upsert(spark.createDataFrame([(s, "1m", d * DAY, float(k), k) for s in "AB" for d in range(4)], ORDERED))
    want = rows_of(table.read(spark), "symbol", "open_time", "close")
    rounds = []
    fold = sinks.KeyedTable._fold
    monkeypatch.setattr(sinks, "FILES_AT_ONCE", 6)
    monkeypatch.setattr(sinks.KeyedTable, "_fold", lambda *a: rounds.append(fold(*a)) or rounds[-1])
    assert table.compact(spark) == 12 and rounds == [6, 6]
    assert rows_of(table.read(spark), "symbol", "open_time", "close") == want and table.changes(spark).count() == 8
    assert table.compact(spark, F.col("date") == "2999-01-01") == 0


def test_empty_upsert_changes_nothing(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    empty = spark.createDataFrame([], SCHEMA)
    table.upsert(empty)
    table.upsert(spark.createDataFrame([("A", "1m", 0, 1.0, "x")], SCHEMA))
    table.upsert(empty)
    assert table.read(spark).count() == 1


def test_append_once_and_expiry(spark, tmp_path):
    path = str(tmp_path / "history")
    day = lambda n: spark.createDataFrame([("A", n * DAY + 5)], "symbol STRING, timestamp BIGINT")
    sinks.append_once(day(0).unionByName(day(1)), path, "timestamp", "q:0")
    for _ in range(2):
        sinks.append_once(day(1), path, "timestamp", "q:1")
    assert rows_of(spark.read.parquet(path), "timestamp") == [(5,), (DAY + 5,), (DAY + 5,)]
    assert sorted(p.name for p in (tmp_path / "history").iterdir() if p.is_dir()) == ["date=1970-01-01", "date=1970-01-02"]
    dropped = sinks.expire_days(spark, path, "1970-01-02")
    assert [d.rsplit("/", 1)[1] for d in dropped] == ["date=1970-01-01"]
    assert rows_of(spark.read.parquet(path), "timestamp") == [(DAY + 5,), (DAY + 5,)]


@pytest.mark.parametrize("interval, kept", [("1h", "1970-01-01"), ("1d", "1970-01-01"), ("1m", "1970-01-02")])
def test_expiry_leaves_partitions_with_live_days(spark, tmp_path, interval, kept):
    table = sinks.CandleTable(str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([("A", interval, k * DAY, 1.0, "x") for k in range(31)], SCHEMA))
    folder = f"{table.path}/interval={interval}"
    sinks.expire_days(spark, folder, "1970-01-02", interval)
    assert table.read(spark).agg(F.min("date").cast("string")).first()[0] == kept
    assert table.read(spark).where(f"open_time >= {DAY}").count() == 30
    sinks.expire_days(spark, folder, "1971-01-01", interval)
    assert not list((tmp_path / "t").rglob("*.parquet"))


def test_a_replaced_table_is_always_there(spark, tmp_path):
    path = str(tmp_path / "latest")
    with pytest.raises(FileNotFoundError):
        sinks.read_latest(spark, path)
    opened = None
    for k in range(4):
        sinks.replace_table(spark.range(k, k + 1), path)
        assert sinks.read_latest(spark, path).first()[0] == k
        if opened:
            assert opened.first()[0] == k - 1  # a reader of the version before still has it
        opened = sinks.read_latest(spark, path)
    assert len(list((tmp_path / "latest").iterdir())) == 2
    (tmp_path / "latest" / "v99999999999999999999").mkdir()  # a writer that was cut off
    assert sinks.read_latest(spark, path).first()[0] == 3


def test_rollup_job_is_repeatable(spark, tmp_path, trades):
    from tapewright.operators.candles import ohlcv

    table = sinks.CandleTable(str(tmp_path / "t"))
    rows = [("A", k, float(k), 1.0, k * 30_000, True) for k in range(40)]
    table.upsert(ohlcv(trades(rows), "1m"))
    for _ in range(2):
        roll_last_closed(spark, table, "5m", as_of=900_123)
    got = rows_of(table.read(spark).where("interval = '5m'"), "open_time", "open", "close", "trades", "source")
    assert got == [(600_000, 20.0, 29.0, 10, "spark_5m_aggregator")]


def test_scans_prune_partitions_and_push_filters(spark, tmp_path):
    table = sinks.CandleTable(str(tmp_path / "t"))
    rows = [("A", i, n * DAY, 1.0, "x") for i in ("1m", "1d") for n in range(4)]
    table.upsert(spark.createDataFrame(rows, SCHEMA))
    scan = tables.scan_candles(table.read(spark), "1d", ["A"], DAY, 3 * DAY)
    assert rows_of(scan, "interval", "open_time") == [("1d", DAY), ("1d", 2 * DAY)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = scan.select("close")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(open_time" in plan and "LessThan(open_time" in plan
    partition_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "interval" in partition_filters and "date" in partition_filters
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "source" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("interval", ["1m", "5m", "1h", "4h", "1d"])
def test_partition_bounds_lose_no_candle(spark, tmp_path, interval):
    table = sinks.CandleTable(str(tmp_path / "t"))
    times = [0, 20 * DAY, 40 * DAY, 364 * DAY, 365 * DAY]
    table.upsert(spark.createDataFrame([("A", interval, t, 1.0, "x") for t in times], SCHEMA))
    for start, end in [(0, 20 * DAY), (20 * DAY, 40 * DAY), (40 * DAY, 365 * DAY), (364 * DAY, 400 * DAY)]:
        want = [(t,) for t in times if start <= t < end]
        assert rows_of(tables.scan_candles(table.read(spark), interval, None, start, end), "open_time") == want
        whole = tables.time_range(table.read(spark), start, end)
        assert whole.count() == sum(start <= t <= end for t in times)


def test_scan_windows(spark):
    df = spark.createDataFrame([("A", "5m", t * 300_000, 1.0, "x") for t in range(100)], SCHEMA)
    as_of = 99 * 300_000
    assert tables.scan_training_window(df, as_of).count() == 100
    recent = tables.scan_recent(df, as_of, periods=40).agg(F.min("open_time"), F.max("open_time")).first()
    assert tuple(recent) == (59 * 300_000, 98 * 300_000)  # the last candle has only begun
    assert tables.scan_recent(df, as_of, symbols=["B"]).count() == 0
