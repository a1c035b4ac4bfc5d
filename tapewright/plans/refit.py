"""Refitting the model over a sliding span of days from statistics of each day.

A day's rows are read once, when the day is new: its count, means and co-moments of the
features and the label are all that a ridge fit needs of it. The statistics of a span are
those of its days put together, so moving the span on by a day adds one and takes one away,
and the fit solves a system of as many equations as there are features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.plans.training import LABEL, REG_PARAM
from tapewright.schemas import FEATURES, WIDTH_MS
from tapewright.sources.sinks import KeyedTable
from tapewright.sources.tables import day_of

COLUMNS = [*FEATURES, LABEL]
_PAIRS = [(a, b) for k, a in enumerate(COLUMNS) for b in COLUMNS[k:]]


@dataclass(frozen=True)
class Moments:
    """Count, means and centred co-moments of some rows; exact sums would cancel."""

    n: int
    mean: np.ndarray
    moment: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        return Moments(n, mean, self.moment + other.moment + np.outer(apart, apart) * (self.n * other.n / n))

    def __sub__(self, other: Moments) -> Moments:
        n = self.n - other.n
        if n <= 0:
            return empty()
        mean = (self.mean * self.n - other.mean * other.n) / n
        apart = other.mean - mean
        return Moments(n, mean, self.moment - other.moment - np.outer(apart, apart) * (n * other.n / self.n))


def empty() -> Moments:
    width = len(COLUMNS)
    return Moments(0, np.zeros(width), np.zeros((width, width)))


def day_statistics(table: DataFrame) -> DataFrame:
    """One row for each day of training rows; partial aggregation leaves little to shuffle."""
    dated = table.withColumn("date", day_of(F.col("open_time")))
    n = F.count(F.lit(1))
    means = F.array(*(F.avg(c) for c in COLUMNS)).alias("means")
    moments = F.array(*(F.covar_pop(a, b) * n for a, b in _PAIRS)).alias("moments")
    return dated.groupBy("date").agg(n.alias("n"), means, moments)


class DayStatistics:
    """Stored statistics of days. A day that is added again replaces itself."""

    def __init__(self, path: str):
        fields = T.StructType.fromDDL("day string, n bigint, means array<double>, moments array<double>, month string")
        self.table = KeyedTable(path, fields, ["day"], ["month"])

    def add(self, table: DataFrame) -> None:
        """Statistics of the days that ``table`` holds, each of them whole."""
        found = day_statistics(table).withColumnRenamed("date", "day")
        self.table.upsert(found.withColumn("month", F.substring("day", 1, 7)))

    def read(self, spark: SparkSession, first: str, last: str) -> dict[str, Moments]:
        """Statistics of the days from ``first`` to ``last``: at most one small row a day."""
        months = F.col("month").between(first[:7], last[:7])
        rows = self.table.read(spark).where(months & F.col("day").between(first, last)).select("day", "n", "means", "moments").collect()
        upper = np.triu_indices(len(COLUMNS))
        out = {}
        for day, n, means, moments in rows:
            square = np.zeros((len(COLUMNS),) * 2)
            square[upper] = moments
            out[day] = Moments(n, np.array(means), square + np.triu(square, 1).T)
        return out


def solve(moments: Moments, reg_param: float = REG_PARAM) -> dict:
    """The parameters ``training.parameters`` gives for a ridge fit over the same rows.

    Features are scaled to unit variance, and the penalty to the label's deviation; one that
    does not vary gets no weight.
    """
    if moments.n < 2:
        raise ValueError("a fit needs two rows")
    covariance = moments.moment / moments.n
    deviation = np.sqrt(np.clip(np.diag(covariance), 0, None))
    label, wide = deviation[-1], deviation[:-1]
    varies = wide > 0
    weights = np.zeros(len(FEATURES))
    if label > 0 and varies.any():
        scale = wide[varies]
        gram = covariance[:-1, :-1][np.ix_(varies, varies)] / np.outer(scale, scale) + np.eye(len(scale)) * (reg_param / label)
        weights[varies] = np.linalg.solve(gram, covariance[:-1, -1][varies] / scale)
    sample = np.sqrt(moments.n / (moments.n - 1))
    named = lambda values: dict(zip(FEATURES, map(float, values), strict=True))
    return {
        "model_type": "LinearRegression",
        "features": list(FEATURES),
        "intercept": float(moments.mean[-1]),
        "coefficients": named(weights * sample),
        "scaler_mean": named(moments.mean[:-1]),
        "scaler_std": named(wide * sample),
        "metrics": {},
    }


def day_name(time_ms: int) -> str:
    return str(np.datetime64(time_ms, "ms").astype("datetime64[D]"))


def day_before(day: str, days: int) -> str:
    return str(np.datetime64(day, "D") - days)


def sliding_fits(days: dict[str, Moments], first: str, last: str, span: int) -> dict[str, dict]:
    """Parameters for every day from ``first`` to ``last``, each fitted over the ``span`` days
    that end with it: one day is added and one taken away at a time."""
    width, total, out = WIDTH_MS["1d"], empty(), {}
    begin, end = (int(np.datetime64(d, "D").astype("datetime64[ms]").astype(int)) for d in (first, last))
    for time in range(begin - (span - 1) * width, end + width, width):
        total = total + days.get(day_name(time), empty())
        if time >= begin:
            if total.n >= 2:
                out[day_name(time)] = solve(total)
            total = total - days.get(day_name(time - (span - 1) * width), empty())
    return out
