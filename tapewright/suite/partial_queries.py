"""Measures folded from stored summaries of minutes and days."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.operators import partials
from tapewright.plans import refit
from tapewright.schemas import FEATURES, TRADE, WIDTH_MS
from tapewright.streaming import stateful
from tapewright.streaming.supervise import await_all
from tapewright.suite.inputs import SPAN_DAYS, Inputs
from tapewright.suite.registry import query
from tapewright.suite.sql import fitted_sql
from tapewright.suite.stream_queries import json_stream

MARKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
RATIO = partials.ratio()


def _starts(time: str, width: int, slide: int) -> str:
    return f"unnest(range({time} - {time} % {slide} - {width - slide}, {time} - {time} % {slide} + 1, {slide}))"


def _sketched(width: int, slide: int) -> str:
    """The quantiles of logarithmic buckets, from all events of a window."""
    marks = ", ".join(f"min(CASE WHEN rank >= {q} * total THEN middle END) AS {n}" for n, q in MARKS.items())
    return f"""SELECT window_start, CAST(max(total) AS BIGINT) AS events, {marks}
FROM (SELECT window_start, CASE WHEN bucket IS NULL THEN 0.0 ELSE 2 * pow({RATIO!r}, bucket) / {RATIO + 1!r} END AS middle,
  sum(n) OVER (PARTITION BY window_start ORDER BY bucket NULLS FIRST) AS rank, sum(n) OVER (PARTITION BY window_start) AS total
FROM (SELECT window_start, bucket, count(*) AS n FROM (SELECT {_starts("trade_time", width, slide)} AS window_start,
  CASE WHEN price > 0 THEN ceil(ln(price) / {math.log(RATIO)!r}) END AS bucket FROM tape) GROUP BY ALL)) GROUP BY window_start"""


MINUTES_5, MINUTES_15, HOUR = 300_000, 900_000, WIDTH_MS["1h"]


@query("latency_quantiles_sliding", _sketched(MINUTES_15, MINUTES_5), " ".join(MARKS))
def _sliding(i: Inputs) -> DataFrame:
    """Quarters of an hour, one every five minutes, from sketches of minutes."""
    stored = i.stored(partials.quantile_partials(i.tape, "trade_time", "price"), "sketches")
    return partials.quantiles(stored, MARKS, MINUTES_15, MINUTES_5)


@query("stream_latency_quantiles", _sketched(MINUTES_5, MINUTES_5), " ".join(MARKS))
def _streamed(i: Inputs) -> DataFrame:
    """Windows of five minutes from sketches that a stream has stored."""
    table = partials.quantile_table(i.scratch("sketches"))
    stream = json_stream(i, i.trades, TRADE)
    await_all([stateful.start_quantile_partials(stream, "trade_time", "price", table, i.scratch("checkpoint"), None)])
    return partials.quantiles(table.read(i.spark), MARKS, MINUTES_5)


@query(
    "error_ratio_sliding",
    f"""SELECT window_start, count(*) AS events, CAST(count_if(failed) AS BIGINT) AS errors, count(*) / 900 AS per_second,
  count_if(failed) * 100.0 / count(*) AS error_pct
FROM (SELECT {_starts("trade_time", MINUTES_15, MINUTES_5)} AS window_start, symbol = 'error' AS failed FROM tape) GROUP BY window_start""",
    "per_second error_pct",
)
def _errors(i: Inputs) -> DataFrame:
    requests = i.tape.select("trade_time", (F.col("symbol") == "error").alias("failed"))
    stored = i.stored(partials.count_partials(requests, "trade_time", "failed"), "counts")
    return partials.error_ratio(stored, MINUTES_15, MINUTES_5)


SAMPLES = f"""SELECT symbol AS topic, trade_time, trade_id, row_number() OVER (PARTITION BY symbol, trade_time // {WIDTH_MS["1d"]}
  ORDER BY trade_time, trade_id) AS value FROM tape"""


@query(
    "counter_rate_sliding",
    f"""SELECT topic, window_start, CAST(sum(CASE WHEN before_time < window_start OR before IS NULL THEN 0
    WHEN value >= before THEN value - before ELSE value END) AS BIGINT) AS increase, count(*) AS samples,
  sum(CASE WHEN before_time < window_start OR before IS NULL THEN 0
    WHEN value >= before THEN value - before ELSE value END) / {6 * HOUR / 1000!r} AS per_second
FROM (SELECT *, {_starts("trade_time", 6 * HOUR, HOUR)} AS window_start FROM (SELECT *,
  lag(value) OVER w AS before, lag(trade_time) OVER w AS before_time FROM ({SAMPLES})
  WINDOW w AS (PARTITION BY topic ORDER BY trade_time, trade_id))) GROUP BY topic, window_start""",
    "per_second",
    places=9,
)
def _counters(i: Inputs) -> DataFrame:
    """Message counters of every topic, which start anew each day, over windows of six hours."""
    day = F.expr(f"trade_time div {WIDTH_MS['1d']}")
    value = F.row_number().over(Window.partitionBy("symbol", day).orderBy("trade_time", "trade_id")).cast("bigint")
    samples = i.tape.select(F.col("symbol").alias("topic"), "trade_time", "trade_id", value.alias("value"))
    stored = i.stored(partials.counter_partials(samples, ["topic"], "trade_time", "value", "trade_id"), "counters")
    return partials.counter_rate(stored, ["topic"], 6 * HOUR, HOUR)


FITTED, FROM_SPAN = fitted_sql("span")


@query(
    "ml_refit_sliding",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, CAST(n AS BIGINT) AS n, s.means[{i}] AS mean, s.deviations[{i}] * sqrt(n / (n - 1)) AS std,
  x.m[{i}][{len(FEATURES) + 1}] * sqrt(n / (n - 1)) AS coefficient, s.intercept FROM {FROM_SPAN}"""
        for i, name in enumerate(FEATURES, 1)
    ),
    "mean std coefficient intercept",
    places=5,
)
def _refit(i: Inputs) -> DataFrame:
    """The last of the fits over ten days each, moved on day by day from stored statistics."""
    stored = refit.DayStatistics(i.scratch("statistics"))
    stored.add(i.stored(i.training, "training"))
    days = stored.read(i.spark, "2000-01-01", "2100-01-01")
    first, last = min(days), max(days)
    name, params = sorted(refit.sliding_fits(days, first, last, SPAN_DAYS).items())[-1]
    n = sum(m.n for d, m in days.items() if d > refit.day_before(name, SPAN_DAYS))
    rows = [(f, n, params["scaler_mean"][f], params["scaler_std"][f], params["coefficients"][f], params["intercept"]) for f in FEATURES]
    return i.spark.createDataFrame(rows, "feature string, n bigint, mean double, std double, coefficient double, intercept double")
