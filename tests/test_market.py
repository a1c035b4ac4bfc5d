import pytest
from conftest import rows_of

from tapewright.operators import activity, joins, ranking, serving, state
from tapewright.plans.forecast import recent_or_latest

HEALTH = [
    ("BTCUSDT", 71500.0, 12.5, 1712707200000),
    ("BTCUSDT", 71884.5, 15.2, 1712707260000),
    ("BTCUSDT", 71420.3, 10.3, 1712707320000),
    ("ETHUSDT", 3500.0, 150.1, 1712707200000),
    ("ETHUSDT", 3550.5, 120.5, 1712707260000),
    ("ETHUSDT", 3490.8, 180.8, 1712707320000),
    ("BNBUSDT", 605.0, 500.0, 1712707200000),
    ("BNBUSDT", 612.5, 450.0, 1712707260000),
    ("BNBUSDT", 598.0, 600.0, 1712707320000),
]


def test_health_job_rows(spark):
    df = spark.createDataFrame(HEALTH, "symbol STRING, price DOUBLE, volume DOUBLE, timestamp BIGINT")
    assert df.where("symbol = 'BTCUSDT'").count() == 3
    got = {r.symbol: r for r in activity.basic_stats(df).collect()}
    assert got["BTCUSDT"].total_volume == pytest.approx(38.0)
    assert got["BTCUSDT"].avg_price == pytest.approx(71601.6)
    assert got["ETHUSDT"].avg_price == pytest.approx(3513.766667)
    assert (got["BNBUSDT"].max_price, got["BNBUSDT"].min_price) == (612.5, 598.0)
    counts = activity.count_rows_and_symbols(df).collect()[0]
    assert (counts.rows, counts.symbols) == (9, 3)


@pytest.fixture
def ranked(spark):
    rows = [("A", 1.0, 5.0, 1), ("B", 1.0, -3.0, 1), ("C", 1.0, 0.0, 1), ("D", 1.0, 9.0, 1), ("E", 1.0, None, 1)]
    return spark.createDataFrame(rows, "symbol STRING, price DOUBLE, percent_change DOUBLE, timestamp BIGINT")


def test_top_n(ranked):
    assert [r.symbol for r in ranking.top_n(ranked, 2).collect()] == ["D", "A"]
    assert [r.symbol for r in ranking.top_n(ranked, 2, losers=True).collect()] == ["B", "C"]
    assert [(r.position, r.symbol) for r in ranking.top_n_strict(ranked).collect()] == [(1, "D"), (2, "A")]
    assert [(r.position, r.symbol) for r in ranking.top_n_strict(ranked, losers=True).collect()] == [(1, "B")]


def test_sentiment(ranked):
    row = ranking.sentiment(ranked).collect()[0]
    assert (row.gainers, row.losers, row.total, row.score, row.label) == (2, 1, 5, 40, "Bearish")
    # 29 of 200: the share is 14.499999999999998 in floating point and rounds down.
    many = ranked.sparkSession.range(200).selectExpr("IF(id < 29, 1.0D, -1.0D) AS percent_change")
    assert ranking.sentiment(many).collect()[0].score == 14
    empty = ranking.sentiment(ranked.limit(0)).collect()[0]
    assert (empty.total, empty.score, empty.label) == (0, 50, "Neutral")


def test_session_change(trades):
    df = trades(
        [
            ("A", 5, 30.0, 1.0, 200_000_000, True),
            ("A", 4, 20.0, 1.0, 200_000_000, True),
            ("A", 1, 10.0, 1.0, 1_000, True),
            ("Z", 2, 0.0, 1.0, 0, True),
            ("Z", 3, 4.0, 1.0, 10, True),
        ]
    )
    got = rows_of(ranking.session_change(df), "symbol", "open", "close", "last_update", "percent_change")
    assert got == [("A", 10.0, 30.0, 200_000_000, 200.0), ("Z", 0.0, 4.0, 10, None)]
    assert rows_of(ranking.session_change(df, since=2_000), "symbol", "open") == [("A", 20.0)]


@pytest.mark.parametrize("block_ms", [1, 1_000, 3_600_000])
def test_tick_direction_over_blocks(trades, block_ms):
    prices = [0.0, 5.0, 5.0, 4.0, 6.0]
    df = trades([("A", k, p, 1.0, (k // 2) * 700, True) for k, p in enumerate(prices)])
    got = sorted((r.trade_id, r.prev_price, r.direction, r.change_pct) for r in ranking.tick_direction(df, block_ms=block_ms).collect())
    assert got == [(0, None, None, 0.0), (1, 0.0, "up", 0.0), (2, 5.0, "flat", 0.0), (3, 5.0, "down", -20.0), (4, 4.0, "up", 50.0)]


def test_pair_discovery_skips_other_quotes_and_bad_volumes(spark):
    rows = [("AUSDT", "5"), ("BUSDT", "n/a"), ("CBTC", "9"), ("DUSDT", "7"), ("EUSDT", None), ("FUSDT", "1")]
    df = spark.createDataFrame(rows, "symbol STRING, quote_volume STRING")
    assert [r.symbol for r in ranking.discover_pairs(df, min_volume=5.0).collect()] == ["dusdt", "ausdt"]
    assert ranking.discover_pairs(df, min_volume=1.0, max_pairs=1).count() == 1
    assert rows_of(ranking.split_pair(df), "base")[0] == ("A",)


def test_universe_change(spark):
    old = spark.createDataFrame([("a",), ("b",), ("b",)], "symbol STRING")
    new = spark.createDataFrame([("b",), ("c",), ("c",)], "symbol STRING")
    assert rows_of(ranking.universe_change(old, new), "symbol", "change") == [("a", "removed"), ("c", "added")]
    assert ranking.universe_change(old, old).count() == 0


def test_trade_flow_and_pair_stats(spark, trades):
    df = trades([("A", 1, 5.0, 3.0, 100, False), ("A", 2, 6.0, 1.0, 200, True), ("B", 3, 1.0, 0.0, 5, True)])
    assert rows_of(activity.trade_flow(df), "symbol", "buy_pct") == [("A", 75.0), ("B", 50.0)]
    bars = spark.createDataFrame(
        [("A", "1m", 9.0, 300), ("A", "5m", 8.0, 400)], "symbol STRING, interval STRING, close DOUBLE, event_time BIGINT"
    )
    report = activity.pair_report(activity.pair_stats(bars, df))
    assert rows_of(report, "symbol", "messages", "last_price") == [("A", 3, 9.0), ("B", 1, 1.0), ("TOTAL", 4, None)]


def test_rates_and_quantiles(spark):
    rows = [(k * 1000, "t", k == 3, float(k)) for k in range(10)]
    df = spark.createDataFrame(rows, "time BIGINT, topic STRING, failed BOOLEAN, took DOUBLE")
    assert activity.throughput(df, "time", ["topic"]).collect()[0].per_second == pytest.approx(10 / 60)
    assert activity.error_ratio(df, "time", "failed").collect()[0].error_pct == 10.0
    row = activity.latency_quantiles(df, "time", "took").collect()[0]
    assert (row.p50, row.p95, row.p99) == (4.0, 9.0, 9.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)], "target DOUBLE, prediction DOUBLE")
    row = activity.regression_metrics(df).collect()[0]
    assert row.rmse == pytest.approx((1 / 3) ** 0.5) and row.mae == pytest.approx(1 / 3)
    assert row.r2 == pytest.approx(1 - 1 / (14 / 3))


def test_lookup_prefers_whole_hot_rows(spark):
    symbols = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol STRING")
    hot = spark.createDataFrame([("A", 1.0, None), ("X", 9.0, "n")], "symbol STRING, v DOUBLE, note STRING")
    cold = spark.createDataFrame([("A", 2.0, "old"), ("B", 3.0, "old")], "symbol STRING, v DOUBLE, note STRING")
    got = rows_of(joins.lookup_hot_cold(symbols, hot, cold), "symbol", "tier", "v", "note")
    assert got == [("A", "hot", 1.0, None), ("B", "cold", 3.0, "old")]


def test_with_actuals_keeps_pending(spark):
    predictions = spark.createDataFrame(
        [("A", 0, 10.0, 11.0), ("A", 600_000, 10.0, 11.0)],
        "symbol STRING, open_time BIGINT, close DOUBLE, predicted_price DOUBLE",
    )
    candles = spark.createDataFrame([("A", 300_000, 12.5)], "symbol STRING, open_time BIGINT, close DOUBLE")
    got = rows_of(joins.with_actuals(predictions, candles), "open_time", "actual_price", "actual_change", "accuracy")
    assert got == [(0, 12.5, 25.0, 88.0), (600_000, None, None, None)]


def test_broadcast_only_below_the_row_bound(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(10).withColumnRenamed("id", "symbol")
        dim = spark.range(5).selectExpr("id AS symbol", "id AS v")
        assert "BroadcastHashJoin" in plan(facts.join(joins.broadcast_if_small(dim), "symbol", "left"))
        assert "BroadcastHashJoin" not in plan(facts.join(joins.broadcast_if_small(dim, 4), "symbol", "left"))
        assert "BroadcastHashJoin" not in plan(facts.join(joins.broadcast_if_small(dim, max_bytes=9), "symbol", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _klines(spark, n, closed=lambda k: True, interval="1m"):
    rows = [("A", interval, k * 60_000, float(k), closed(k)) for k in range(n)]
    return spark.createDataFrame(rows, "symbol STRING, interval STRING, open_time BIGINT, close DOUBLE, is_closed BOOLEAN")


def test_pages(spark):
    df = _klines(spark, 10, closed=lambda k: k != 9)
    minutes = lambda page: [r.open_time // 60_000 for r in page.collect()]
    assert minutes(serving.candles_page_before(df, "A", 5 * 60_000, n=3)) == [2, 3, 4]
    assert minutes(serving.candles_page_until(df, "A", 5 * 60_000, n=3)) == [0, 1, 2]
    assert minutes(serving.candles_latest(df, "A", "1m", 2)) == [8, 9]
    assert minutes(serving.candles_latest(df, "A", "1m", 2, end=5 * 60_000)) == [4, 5]
    assert minutes(serving.candles_latest(df, "A", "1m", 9, start=8 * 60_000)) == [8, 9]
    assert minutes(serving.candles_closed(df, "A", n=2)) == [8]  # the limit comes first
    unmarked = df.drop("is_closed").withColumn("close_time", df.open_time + 60_000)
    assert minutes(serving.candles_closed(unmarked, "A", n=2)) == []
    assert minutes(serving.candles_closed(unmarked, "A", n=2, as_of=9 * 60_000)) == [8]
    renamed = df.withColumnRenamed("is_closed", "x")
    assert minutes(serving.candles_closed(renamed, "A", n=2)) == [8]


def test_fallback_counts_rows_of_all_symbols(spark):
    recent, older = _klines(spark, 3), _klines(spark, 5)
    assert serving.fallback_source(recent, older, 3).count() == 3
    assert serving.fallback_source(recent, older, 4).count() == 5
    candles = _klines(spark, 100, interval="5m")
    assert recent_or_latest(candles, as_of=0).count() == 0
    assert recent_or_latest(candles, as_of=24 * 60_000).count() == 20  # too few recent ones: all that are closed
    assert recent_or_latest(candles, as_of=10**12).count() == 40


def test_recent_trades_collapses_copies(trades):
    rows = [("A", k, 1.0, 1.0, k, True) for k in range(5)] + [("B", 1, 1.0, 1.0, 1, True)]
    df = trades(rows * 40)
    got = state.recent_trades(df.repartition(6), keep=3)
    assert rows_of(got, "symbol", "trade_id") == [("A", 2), ("A", 3), ("A", 4), ("B", 1)]


def test_retention_and_unique_keys(spark):
    df = _klines(spark, 3)
    assert rows_of(state.retain(df, 60, 120_000), "open_time") == [(120_000,)]
    assert state.duplicate_keys(df, ["symbol", "open_time"]).count() == 0
    state.assert_unique(df, ["symbol", "open_time"])
    with pytest.raises(ValueError, match="duplicate key"):
        state.assert_unique(df.unionByName(df), ["symbol", "open_time"])


def test_latest_prediction_defaults_direction(spark):
    rows = [("A", 0, 1.0, 2.0, -3.0, None, "t1", "x"), ("A", 1, 1.0, 2.0, 4.0, "UP", "t0", "y")]
    df = spark.createDataFrame(
        rows,
        "symbol STRING, open_time BIGINT, close DOUBLE, predicted_price DOUBLE, predicted_change_pct DOUBLE, "
        "direction STRING, prediction_time STRING, target_time STRING",
    )
    row = state.latest_prediction(df).collect()[0]
    assert (row.direction, row.confidence_score, row.target_time) == ("UNKNOWN", 3.0, "x")
