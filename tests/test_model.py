import numpy as np
import pytest
from conftest import rows_of
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tapewright.functions import scoring
from tapewright.operators.activity import prediction_summary
from tapewright.operators.features import clean, features
from tapewright.operators.serving import prediction_history
from tapewright.plans import forecast, training
from tapewright.schemas import FEATURES
from tapewright.sources import tables
from tapewright.suite.inputs import PARAMS, Inputs


@pytest.fixture(scope="module")
def table(spark):
    return Inputs(spark, "/root/testdata/sf0.001").training.cache()


def ridge(x, y, reg):
    """Closed form of the regression on standardised columns, penalty in units of the label."""
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    scale, n = z.std(0), len(y)
    unit = z / scale
    gram = unit.T @ unit / n + reg / y.std() * np.eye(z.shape[1])
    weights = np.linalg.solve(gram, unit.T @ (y - y.mean()) / n) / scale
    return weights, y.mean()


def test_fit_equals_closed_form(table):
    rows = table.toPandas()
    weights, intercept = ridge(rows[FEATURES].to_numpy(), rows["target"].to_numpy(), training.REG_PARAM)
    params = training.parameters(training.pipeline().fit(table))
    np.testing.assert_allclose([params["coefficients"][f] for f in FEATURES], weights, rtol=1e-6, atol=1e-8)
    assert params["intercept"] == pytest.approx(intercept)


def test_score_expression_equals_the_pipeline(spark, table):
    model = training.pipeline().fit(table)
    params = training.parameters(model)
    both = model.transform(table).withColumn("folded", scoring.linear_score(params))
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("folded")))).collect()[0][0] < 1e-6


def test_metrics_agree_with_the_evaluator(table):
    scored = forecast.score(table, PARAMS)
    judged = training.evaluate(scored)
    for name in ("rmse", "mae", "r2"):
        assert judged[name] == pytest.approx(RegressionEvaluator(labelCol="target", metricName=name).evaluate(scored))


def test_splits(table):
    train, test = training.time_split(table)
    cut = training.time_cut(table)
    assert train.count() + test.count() == table.count()
    assert train.agg(F.max("open_time")).collect()[0][0] <= cut < test.agg(F.min("open_time")).collect()[0][0]
    a, b = training.random_split(table)
    assert a.count() + b.count() == table.count() and a.count() > b.count() > 0
    again, _ = training.random_split(table.repartition(7, "close"))
    assert rows_of(again, "symbol", "open_time") == rows_of(a, "symbol", "open_time")
    other, _ = training.random_split(table, seed=7)
    assert rows_of(other, "symbol", "open_time") != rows_of(a, "symbol", "open_time")


def test_stored_predictions(spark, bars, tmp_path):
    candles = bars({"A": range(1, 60), "B": range(60, 1, -1)}).withColumn("interval", F.lit("5m"))
    store = forecast.PredictionStore(str(tmp_path / "predictions"))
    for minute in (250, 250, 270):
        forecast.run_forecast(candles, {"intercept": 1.0}, minute * 60_000, store)
    history = store.history.read(spark)
    assert rows_of(history, "symbol", "made_at") == [(s, m * 60_000) for s in "AB" for m in (250, 270)]
    forecast.run_forecast(candles, {"intercept": 2.0}, 260 * 60_000, store)  # an earlier clock, run late
    assert rows_of(store.latest.read(spark), "symbol", "made_at") == [("A", 270 * 60_000), ("B", 270 * 60_000)]
    assert prediction_history(store.history.read(spark), "A", 2).select("made_at").collect()[0][0] == 270 * 60_000


def test_save_and_load(spark, table, tmp_path):
    model = training.pipeline().fit(table)
    params = training.parameters(model, {"rmse": 1.5})
    training.save_model(spark, model, params, str(tmp_path / "model"))
    loaded = tables.params_dict(tables.read_model_params(spark, str(tmp_path / "model" / "params")))
    assert loaded["coefficients"] == pytest.approx(params["coefficients"])
    assert loaded["metrics"] == {"rmse": 1.5}
    again = PipelineModel.load(str(tmp_path / "model" / "pipeline"))
    assert again.stages[2].intercept == pytest.approx(model.stages[2].intercept)


def test_too_few_rows_refuse_to_train(bars):
    with pytest.raises(ValueError, match="at least 100"):
        training.train(bars({"A": range(1, 50)}))


def test_missing_parameters_and_zero_deviation(spark):
    df = spark.createDataFrame([(4.0,)], "rsi DOUBLE").withColumns({f: F.lit(1.0) for f in FEATURES if f != "rsi"})
    score = lambda p: df.select(scoring.linear_score(p)).collect()[0][0]
    assert score({}) == 0.0
    assert score({"intercept": 2.0, "coefficients": {"rsi": 3.0}}) == 14.0
    assert score({"coefficients": {"rsi": 3.0}, "scaler_mean": {"rsi": 2.0}, "scaler_std": {"rsi": 4.0}}) == 1.5
    assert score({"intercept": 2.0, "coefficients": {"rsi": 3.0}, "scaler_std": {"rsi": 0.0}}) == 2.0


def test_zero_prediction_is_down(spark, bars):
    rows = clean(features(bars({"A": [1, 2, 3]})), None)
    flat = forecast.predictions(rows, {}, F.lit("now")).orderBy("open_time").collect()
    assert [(r.direction, r.predicted_price) for r in flat] == [("DOWN", 2.0), ("DOWN", 3.0)]
    assert flat[0].target_time == "1970-01-01 00:10:00"
    up = forecast.predictions(rows, {"intercept": 50.0}, F.lit("now")).orderBy("open_time")
    assert [r.predicted_price for r in up.collect()] == [3.0, 4.5]
    row = prediction_summary(up).collect()[0]
    assert (row.total, row.up_count, row.down_count, row.up_pct, row.max_change) == (2, 2, 0, 100.0, 50.0)
    assert prediction_summary(up.limit(0)).collect()[0].up_pct is None


def test_confidence(spark):
    df = spark.createDataFrame([(-0.5,), (0.7,), (0.1,), (3.0,)], "change DOUBLE")
    score = scoring.confidence(F.col("change"))
    got = [tuple(r) for r in df.select(scoring.confidence_share(score), scoring.confidence_band(score)).collect()]
    assert [s for s, _ in got] == pytest.approx([50.0, 70.0, 10.0, 100.0])
    assert [b for _, b in got] == ["medium", "high", "low", "high"]


def test_forecast_uses_newest_bar_of_each_symbol(bars):
    candles = bars({"A": range(1, 60), "B": range(60, 1, -1)}).withColumn("interval", F.lit("5m"))
    rows = forecast.forecast(candles, {"intercept": 1.0}, as_of=58 * 300_000).orderBy("symbol").collect()
    assert [(r.symbol, r.open_time, r.close) for r in rows] == [("A", 57 * 300_000, 58.0), ("B", 57 * 300_000, 3.0)]
    assert forecast.forecast(candles.where("open_time < 17400000"), {"intercept": 1.0}, as_of=58 * 300_000).orderBy("symbol").collect() == rows
    assert rows[0].prediction_time == "1970-01-01T04:50:00.000Z"
