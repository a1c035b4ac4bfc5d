"""Summaries of minutes and days against the measures over all rows."""

import random

import numpy as np
import pytest

from tapewright.operators import activity, partials
from tapewright.plans import refit, training
from tapewright.schemas import FEATURES, WIDTH_MS

MINUTE, HOUR, DAY = WIDTH_MS["1m"], WIDTH_MS["1h"], WIDTH_MS["1d"]
MARKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


@pytest.mark.parametrize("draw", [lambda r: r.lognormvariate(0, 3), lambda r: r.choice([-1, 1]) * r.random(), lambda r: float(r.randrange(-2, 3))])
def test_quantiles_stay_within_their_error(spark, draw):
    rng = random.Random(4)
    rows = [(rng.randrange(0, 3 * HOUR), draw(rng)) for _ in range(6000)] + [(5, None), (None, 1.0), (7, float("nan"))]
    events = spark.createDataFrame(rows, "t bigint, v double")
    stored = partials.quantile_partials(events, "t", "v")
    exact = {r.window_start: r for r in activity.latency_quantiles(events.where("v is not null and not isnan(v) and t is not null"), "t", "v", 10 * MINUTE).collect()}
    got = {r.window_start: r for r in partials.quantiles(stored, MARKS, 10 * MINUTE).collect()}
    assert got.keys() == exact.keys()
    for start, row in got.items():
        assert row.events == exact[start].events
        for name in MARKS:
            assert abs(row[name] - exact[start][name]) <= partials.ERROR * abs(exact[start][name]) + 1e-12


def test_a_window_is_whole_slides_of_whole_minutes(spark):
    stored = partials.quantile_partials(spark.createDataFrame([(0, 1.0)], "t bigint, v double"), "t", "v")
    for width, slide in ((90_000, 60_000), (60_000, 30_000)):
        with pytest.raises(ValueError, match="multiple"):
            partials.quantiles(stored, MARKS, width, slide)
    assert sorted(r.window_start for r in partials.quantiles(stored, MARKS, 3 * MINUTE, MINUTE).collect()) == [-2 * MINUTE, -MINUTE, 0]


def test_counters_with_restarts(spark):
    rng = random.Random(9)
    rows = []
    for topic in ("a", "b"):
        value = 0
        for seq, t in enumerate(sorted(rng.randrange(0, 3 * DAY) for _ in range(800))):
            value = rng.randrange(3) if rng.random() < 0.02 else value + rng.randrange(5)
            rows.append((topic, t, seq, value))
    samples = spark.createDataFrame(rows, "topic string, t bigint, seq bigint, v bigint").repartition(6)
    stored = partials.counter_partials(samples, ["topic"], "t", "v", "seq")
    got = {(r.topic, r.window_start): (r.increase, r.samples) for r in partials.counter_rate(stored, ["topic"], 4 * HOUR, HOUR).collect()}
    want = {}
    for topic in ("a", "b"):
        mine = [r for r in rows if r[0] == topic]
        for start in range(-3 * HOUR, 3 * DAY, HOUR):
            inside = [r for r in mine if start <= r[1] < start + 4 * HOUR]
            if inside:
                grown = sum(y[3] - x[3] if y[3] >= x[3] else y[3] for x, y in zip(inside, inside[1:]))
                want[topic, start] = (grown, len(inside))
    assert got == want


def table_of(spark, days=14, rows=60):
    rng = np.random.default_rng(3)
    out = []
    for day in range(days):
        for k in range(rows):
            x = rng.normal(1000.0 + day, 0.5 + np.arange(len(FEATURES)))
            out.append(("A", day * DAY + k * 1000, 1.0, float(x[0] - 0.3 * x[3] + rng.normal()), *map(float, x)))
    return spark.createDataFrame(out, "symbol string, open_time bigint, close double, target double, " + ", ".join(f"{f} double" for f in FEATURES))


def test_a_sliding_refit_equals_the_fit_over_its_days(spark, tmp_path):
    table = table_of(spark).cache()
    stored = refit.DayStatistics(str(tmp_path / "days"))
    for day in (7, 14):  # in two deliveries, the second of which repeats the first
        stored.add(table.where(f"open_time < {day * DAY}"))
    days = stored.read(spark, "1970-01-01", "1970-01-31")
    assert len(days) == 14 and all(m.n == 60 for m in days.values())
    fits = refit.sliding_fits(days, "1970-01-06", "1970-01-14", 5)
    for last in (6, 10, 14):
        rows = table.where(f"open_time >= {(last - 5) * DAY} and open_time < {last * DAY}")
        whole = refit.solve(next(iter({d: m for d, m in one_day(refit.day_statistics(collapsed(rows))).items()}.values())))
        got = fits[f"1970-01-{last:02d}"]
        library = training.parameters(training.pipeline().fit(rows))
        for part in ("coefficients", "scaler_mean", "scaler_std"):
            for f in FEATURES:
                assert got[part][f] == pytest.approx(whole[part][f], rel=1e-9, abs=1e-9)
                assert got[part][f] == pytest.approx(library[part][f], rel=1e-6, abs=1e-6)
        assert got["intercept"] == pytest.approx(whole["intercept"], rel=1e-9)


def collapsed(rows):
    """All rows on one day, so that their statistics come from one pass over them."""
    return rows.withColumn("open_time", rows["open_time"] * 0)


def one_day(statistics):
    out = {}
    upper = np.triu_indices(len(refit.COLUMNS))
    for r in statistics.collect():
        square = np.zeros((len(refit.COLUMNS),) * 2)
        square[upper] = r.moments
        out[r.date] = refit.Moments(r.n, np.array(r.means), square + np.triu(square, 1).T)
    return out


def test_a_feature_that_does_not_vary_gets_no_weight():
    width = len(refit.COLUMNS)
    moments = refit.Moments(10, np.ones(width), np.diag([0.0] + [10.0] * (width - 1)))
    params = refit.solve(moments)
    assert params["coefficients"][FEATURES[0]] == 0.0 and params["scaler_std"][FEATURES[0]] == 0.0
    with pytest.raises(ValueError):
        refit.solve(refit.empty())


def test_adding_and_taking_away_days():
    rng = np.random.default_rng(5)
    width = len(refit.COLUMNS)

    def of(rows):
        mean = rows.mean(axis=0)
        return refit.Moments(len(rows), mean, (rows - mean).T @ (rows - mean))

    a, b = rng.normal(50, 1, (30, width)), rng.normal(80, 2, (20, width))
    both = of(a) + of(b)
    want = of(np.vstack([a, b]))
    assert both.n == 50 and np.allclose(both.mean, want.mean) and np.allclose(both.moment, want.moment)
    back = both - of(a)
    assert back.n == 20 and np.allclose(back.mean, of(b).mean) and np.allclose(back.moment, of(b).moment)
    assert (of(a) - of(a)).n == 0
