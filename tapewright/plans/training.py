"""Training of the next-bar model: ridge regression on standardised features."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.activity import regression_metrics
from tapewright.operators.features import clean, features
from tapewright.operators.serving import enough_rows
from tapewright.schemas import FEATURES, MIN_TRAINING_ROWS
from tapewright.session import materialize

# Solver settings and split.
MAX_ITER, REG_PARAM, ELASTIC_NET = 100, 0.1, 0.0
TRAIN_SHARE, SEED = 0.8, 42

LABEL, PREDICTION = "target", "prediction"


def training_table(candles: DataFrame, interval: str = "5m") -> DataFrame:
    """Complete feature rows with their label."""
    return clean(features(candles, interval)).select("symbol", "open_time", "close", LABEL, *FEATURES)


def scaling() -> list:
    """Stages that turn the feature columns into one standardised vector."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    return [assembler, scaler]


def pipeline() -> Pipeline:
    regression = LinearRegression(
        featuresCol="features",
        labelCol=LABEL,
        predictionCol=PREDICTION,
        maxIter=MAX_ITER,
        regParam=REG_PARAM,
        elasticNetParam=ELASTIC_NET,
    )
    return Pipeline(stages=[*scaling(), regression])


def scale(table: DataFrame) -> DataFrame:
    """Standardised features as columns ``z_<feature>``."""
    fitted = Pipeline(stages=scaling()).fit(table)
    vector = vector_to_array("features")
    return fitted.transform(table).select(
        "symbol", "open_time", *(vector[i].alias(f"z_{name}") for i, name in enumerate(FEATURES))
    )


def random_split(table: DataFrame, seed: int = SEED, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Split at random, by a digest of key and seed; mixes past and future of a symbol.

    A row's side depends on the row alone, so splitting again, on any layout, gives the
    same parts.
    """
    digest = F.md5(F.concat_ws("|", F.col("symbol"), F.col("open_time").cast("string"), F.lit(str(seed))).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < F.lit(math.floor(share * 2**32))
    return table.where(drawn), table.where(~drawn)


def time_cut(table: DataFrame, share: float = TRAIN_SHARE) -> int:
    """Last bar time of the training part: ``share`` of the covered time span."""
    low, high = table.agg(F.min("open_time"), F.max("open_time")).collect()[0]
    return low + math.floor((high - low) * share)


def time_split(table: DataFrame, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train on the earlier part of the covered span and test on the later."""
    cut = time_cut(table, share)
    return table.where(F.col("open_time") <= cut), table.where(F.col("open_time") > cut)


def evaluate(scored: DataFrame) -> dict[str, float]:
    """RMSE, MAE and R2 of scored rows, in one pass."""
    row = regression_metrics(scored, LABEL, PREDICTION).first()
    return {name: row[name] for name in ("rmse", "mae", "r2")}


def parameters(model: PipelineModel, metrics: dict[str, float] | None = None) -> dict:
    """Everything scoring needs, as plain numbers: ten features, whatever the data size."""
    scaler, regression = model.stages[1], model.stages[2]
    named = lambda vector: {name: float(v) for name, v in zip(FEATURES, vector, strict=True)}
    return {
        "model_type": "LinearRegression",
        "features": list(FEATURES),
        "intercept": float(regression.intercept),
        "coefficients": named(regression.coefficients),
        "scaler_mean": named(scaler.mean),
        "scaler_std": named(scaler.std),
        "metrics": metrics or {},
    }


def parameter_frame(spark: SparkSession, params: dict) -> DataFrame:
    """Model parameters as the one-row table ``read_model_params`` reads back."""
    from tapewright.schemas import MODEL_PARAMS

    row = tuple(params.get(name) for name in MODEL_PARAMS.fieldNames())
    return spark.createDataFrame([row], MODEL_PARAMS)


def coefficients(spark: SparkSession, params: dict) -> DataFrame:
    from tapewright.sources.tables import coefficient_table

    return coefficient_table(parameter_frame(spark, params))


def train(candles: DataFrame, interval: str = "5m", split: str = "time") -> tuple[PipelineModel, dict]:
    """Fit and evaluate. Returns the pipeline and its parameters with metrics.

    The feature table feeds the fit and two evaluations, so it is written once to the
    shared folder and read back.
    """
    table = materialize(training_table(candles, interval), "training")
    if not enough_rows(table, MIN_TRAINING_ROWS):
        raise ValueError(f"need at least {MIN_TRAINING_ROWS} complete rows to train")
    parts = time_split(table) if split == "time" else random_split(table)
    model = pipeline().fit(parts[0])
    metrics = {
        f"{part}_{name}": value
        for part, rows in zip(("train", "test"), parts, strict=True)
        for name, value in evaluate(model.transform(rows)).items()
    }
    return model, parameters(model, metrics)


def save_model(spark: SparkSession, model: PipelineModel, params: dict, path: str) -> None:
    """Store the fitted pipeline and its flat parameters."""
    model.write().overwrite().save(f"{path}/pipeline")
    parameter_frame(spark, params).coalesce(1).write.mode("overwrite").json(f"{path}/params")
