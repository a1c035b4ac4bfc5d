"""Physical plans that keep working when the data grows."""

import re

import pytest

from tapewright.operators import candles, features, ranking, state
from tapewright.suite import ORACLES, QUERIES
from tapewright.suite.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"

#: Queries that run to the end when built; their result is a plain read.
EAGER = ("stream_", "src_", "sink_", "ml_", "model_", "state_ranking", "scan_candles")


@pytest.fixture
def plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def inputs(spark):
    return Inputs(spark, FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert operator not in text
    # A window without a partition would bring all rows into one task.
    assert not re.search(r"Window \[.*\], \[\], \[", text)


def test_candles_are_one_hash_shuffle(inputs, plan):
    text = plan(candles.ohlcv(inputs.tape, "5m", inputs.dim))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "Sort [" not in text
    assert "partial_min_by" in text and "BroadcastHashJoin" in text


def test_scan_reads_needed_columns_only(inputs, plan):
    text = plan(inputs.tape.select("symbol", "price"))
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "EqualTo(event_type,click)" in plan(inputs.tape.where("symbol = 'click'"))


def test_cascade_reads_the_tape_once(inputs, plan):
    text = plan(candles.cascade(inputs.bars("1m"), "1d"))
    assert text.count("FileScan") == 1 and "SortAggregate" not in text


def test_rankings_never_sort_everything(inputs, plan):
    ranked = ranking.ranking(ranking.session_change(inputs.tape))
    assert "SortAggregate" not in plan(ranked)
    top = plan(ranking.top_n(ranked, 3))
    assert "TakeOrderedAndProject" in top and "rangepartitioning" not in top


def test_newest_rows_are_cut_before_the_shuffle(inputs, plan):
    for df in (features.latest_k(inputs.bars("5m")), state.recent_trades(inputs.tape), state.latest_candle(inputs.klines("1h"))):
        text = plan(df)
        partial = [m.start() for m in re.finditer(r"WindowGroupLimit.*Partial", text)]
        assert partial


def test_features_shuffle_rows_by_block_once(inputs, plan):
    text = plan(inputs.features())
    above, below = text.split("Union", 1)
    assert "Exchange" not in above and above.count("Sort [") == 1  # the union keeps the partitioning
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, _block#\d+L, 8\), REPARTITION_BY_COL", below)
    assert "ReusedExchange" in below and text.count("FileScan") == 1  # found from the same shuffle


def test_every_query_that_sql_can_express_has_it():
    assert set(QUERIES) == set(ORACLES)
