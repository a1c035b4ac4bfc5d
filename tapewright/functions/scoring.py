"""The linear forecast as a column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewright.functions.candle import banded
from tapewright.schemas import CONFIDENCE_BANDS, CONFIDENCE_FLOOR, FEATURES


def linear_score(params: Mapping, features: Sequence[str] = FEATURES) -> Column:
    """Intercept plus the weighted standardised features, with every number a literal.

    A parameter set lists ten features, so folding it into the plan costs nothing and
    scoring needs neither a join nor a model object on the executors. A feature
    missing from the parameters has mean 0, deviation 1 and weight 0; one with
    deviation 0 contributes nothing.
    """
    mean, std, weight = (params.get(k) or {} for k in ("scaler_mean", "scaler_std", "coefficients"))
    score = F.lit(float(params.get("intercept") or 0.0))
    for name in features:
        deviation = float(std.get(name, 1.0))
        if deviation == 0.0:
            continue
        z = (F.col(name) - float(mean.get(name, 0.0))) / deviation
        score = score + z * float(weight.get(name, 0.0))
    return score


def confidence(change: Column) -> Column:
    return F.abs(change)


def confidence_share(score: Column) -> Column:
    """Confidence as a display percentage, at most 100."""
    return F.least(score * 100, F.lit(100.0))


def confidence_band(score: Column) -> Column:
    return banded(confidence_share(score), CONFIDENCE_BANDS, CONFIDENCE_FLOOR)
