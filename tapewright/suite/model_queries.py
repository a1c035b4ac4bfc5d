"""The next-bar model: scaling, splitting, training, scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import scoring
from tapewright.operators.features import clean
from tapewright.operators.serving import sample_predictions
from tapewright.plans import forecast, training
from tapewright.schemas import FEATURES
from tapewright.sources import tables
from tapewright.suite.inputs import AS_OF, EARLIER, PARAMS, Inputs
from tapewright.suite.registry import query
from tapewright.suite.sql import CUT, NOT_NULL, fitted_sql, forecast_sql, score_sql

Z = [f"z_{name}" for name in FEATURES]


@query(
    "ml_assemble_scale",
    "SELECT symbol, open_time, "
    + ", ".join(f"({n} - avg({n}) OVER ()) / stddev_samp({n}) OVER () AS z_{n}" for n in FEATURES)
    + " FROM training",
    " ".join(Z),
)
def _scale(i: Inputs) -> DataFrame:
    return training.scale(i.stored(i.training, "training"))


@query(
    "ml_split",
    f"""SELECT symbol, open_time, CASE WHEN open_time <= {CUT} THEN 'train' ELSE 'test' END AS part FROM training""",
)
def _split(i: Inputs) -> DataFrame:
    train, test = training.time_split(i.stored(i.training, "training"))
    labelled = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return labelled.select("symbol", "open_time", "part")


@query(
    "ml_split_random",
    f"""SELECT symbol, open_time,
  CASE WHEN CAST('0x' || substr(md5(symbol || '|' || open_time || '|{training.SEED}'), 1, 8) AS BIGINT)
    < {int(training.TRAIN_SHARE * 2**32)} THEN 'train' ELSE 'test' END AS part FROM training""",
)
def _random(i: Inputs) -> DataFrame:
    train, test = training.random_split(i.stored(i.training, "training"))
    labelled = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return labelled.select("symbol", "open_time", "part")


def fitted(i: Inputs) -> tuple[PipelineModel, dict]:
    return training.train(i.bars("1h"), "1h")


FITTED_ALL, FROM_ALL = fitted_sql("all")
FITTED_TRAIN, FROM_TRAIN = fitted_sql("train")


@query(
    "ml_train_ridge",
    f"SELECT symbol, open_time, target, {FITTED_ALL} AS prediction FROM training, {FROM_ALL}",
    "target prediction",
    places=3,
)
def _train(i: Inputs) -> DataFrame:
    """Predicted next change of every complete bar by the model trained on them."""
    table = i.stored(i.training, "training")
    model = training.pipeline().fit(table)
    return model.transform(table).select("symbol", "open_time", "target", "prediction")


def _metrics_sql() -> str:
    """RMSE, MAE and R2 of both parts, one row each."""
    wide = f"""SELECT part, sqrt(avg((target - p) ** 2)) AS rmse, avg(abs(target - p)) AS mae,
  1 - sum((target - p) ** 2) / (var_pop(target) * count(*)) AS r2
FROM (SELECT CASE WHEN open_time <= {CUT} THEN 'train' ELSE 'test' END AS part, target, {FITTED_TRAIN} AS p
  FROM training, {FROM_TRAIN}) GROUP BY part"""
    return " UNION ALL ".join(
        f"SELECT part || '_{name}' AS metric, {name} AS value FROM ({wide})" for name in ("rmse", "mae", "r2")
    )


@query("ml_evaluate", _metrics_sql(), "value", places=3)
def _evaluate(i: Inputs) -> DataFrame:
    _, params = fitted(i)
    frame = training.parameter_frame(i.spark, params)
    return frame.select(F.explode("metrics").alias("metric", "value"))


@query(
    "ml_coefficients",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, s.means[{i}] AS mean, s.deviations[{i}] * sqrt(n / (n - 1)) AS std,
  x.m[{i}][{len(FEATURES) + 1}] * sqrt(n / (n - 1)) AS coefficient, s.intercept FROM {FROM_TRAIN}"""
        for i, name in enumerate(FEATURES, 1)
    ),
    "mean std coefficient intercept",
    places=3,
)
def _coefficients(i: Inputs) -> DataFrame:
    _, params = fitted(i)
    return training.coefficients(i.spark, params)


TRAIN_STATS = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, avg({n}) AS mean, stddev_samp({n}) AS std FROM training WHERE open_time <= {CUT}"
    for n in FEATURES
)


@query("model_save", TRAIN_STATS, "mean std")
def _save(i: Inputs) -> DataFrame:
    """Scaler statistics of a model trained, stored and read back."""
    path = i.scratch("model")
    model, params = fitted(i)
    training.save_model(i.spark, model, params, path)
    PipelineModel.load(f"{path}/pipeline")
    stored = tables.read_model_params(i.spark, f"{path}/params")
    return tables.coefficient_table(stored).select("feature", "mean", "std")


SCORED = f"SELECT symbol, open_time, close, target, {score_sql()} AS prediction FROM features WHERE {NOT_NULL}"


@query("ml_score_expression", f"SELECT symbol, open_time, prediction FROM ({SCORED})", "prediction")
def _score(i: Inputs) -> DataFrame:
    return forecast.score(clean(i.features(), None), PARAMS).select("symbol", "open_time", "prediction")


@query(
    "ml_predictions",
    "SELECT * FROM predictions",
    "predicted_price predicted_change_pct return_1 rsi volatility_5 volume_ratio",
)
def _predictions(i: Inputs) -> DataFrame:
    return i.predictions


@query(
    "ml_forecast_latest",
    f"""SELECT symbol, open_time, close, close * (1 + s / 100) AS predicted_price,
  CASE WHEN s > 0 THEN 'UP' ELSE 'DOWN' END AS direction,
  strftime(make_timestamp({AS_OF} * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS prediction_time,
  strftime(make_timestamp((open_time + 3600000) * 1000), '%Y-%m-%d %H:%M:%S') AS target_time
FROM (SELECT *, {score_sql()} AS s FROM forecast_features
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1) WHERE {NOT_NULL}""",
    "predicted_price",
)
def _forecast(i: Inputs) -> DataFrame:
    newest = forecast.forecast(i.bars("1h"), PARAMS, AS_OF, "1h")
    return newest.select(
        "symbol", "open_time", "close", "predicted_price", "direction", "prediction_time", "target_time"
    )


@query(
    "prediction_store",
    f"""SELECT *, 'history' AS kind FROM ({forecast_sql("earlier_", EARLIER)} UNION ALL {forecast_sql("", AS_OF)})
UNION ALL SELECT *, 'latest' FROM (SELECT * FROM ({forecast_sql("earlier_", EARLIER)} UNION ALL {forecast_sql("", AS_OF)})
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY made_at DESC) = 1)""",
    "predicted_price predicted_change_pct return_1 rsi volatility_5 volume_ratio",
)
def _prediction_store(i: Inputs) -> DataFrame:
    """Runs at the clock, again at the clock, and late for the day before."""
    store = forecast.PredictionStore(i.scratch("predictions"))
    bars = i.stored(i.bars("1h"), "bars")
    for clock in (AS_OF, AS_OF, EARLIER):
        forecast.run_forecast(bars, PARAMS, clock, store, "1h")
    kept = store.history.read(i.spark).drop("date").withColumn("kind", F.lit("history"))
    return kept.unionByName(store.latest.read(i.spark).drop("shard").withColumn("kind", F.lit("latest")))


@query(
    "ml_confidence",
    """SELECT symbol, open_time, confidence, share, CASE WHEN share >= 70 THEN 'high' WHEN share >= 45 THEN 'medium'
  ELSE 'low' END AS band
FROM (SELECT symbol, open_time, abs(predicted_change_pct) AS confidence,
  least(abs(predicted_change_pct) * 100, 100) AS share FROM predictions)""",
    "confidence share",
)
def _confidence(i: Inputs) -> DataFrame:
    score = scoring.confidence(F.col("predicted_change_pct"))
    return i.predictions.select(
        "symbol",
        "open_time",
        score.alias("confidence"),
        scoring.confidence_share(score).alias("share"),
        scoring.confidence_band(score).alias("band"),
    )


@query("sample_predictions", f"{SCORED} AND target IS NOT NULL ORDER BY open_time, symbol LIMIT 10", "target prediction")
def _sample(i: Inputs) -> DataFrame:
    return sample_predictions(forecast.score(i.training, PARAMS))
