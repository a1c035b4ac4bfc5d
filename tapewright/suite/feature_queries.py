"""Window features, newest rows per symbol, and tick direction."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapewright.operators import features as op
from tapewright.operators import ranking
from tapewright.operators.state import latest_prediction
from tapewright.plans.forecast import recent_or_latest
from tapewright.schemas import FEATURES
from tapewright.suite.inputs import AS_OF, Inputs
from tapewright.suite.registry import query

KEY = ["symbol", "open_time"]

#: Query name to the feature columns it shows.
PARTS = {
    "win_lags": ["close_lag1", "close_lag2", "close_lag3"],
    "win_returns": ["return_1", "return_2"],
    "win_moving_avg": ["ma5", "ma10", "ma20"],
    "win_volatility": ["volatility_5", "volatility_10"],
    "win_volume_ratio": ["volume_ma5", "volume_ratio"],
    "win_price_to_ma": ["price_to_ma5", "price_to_ma20"],
    "win_rsi14": ["avg_gain", "avg_loss", "rsi"],
    "win_label_next": ["next_close", "target"],
}

for _name, _columns in PARTS.items():

    @query(_name, f"SELECT symbol, open_time, {', '.join(_columns)} FROM features", " ".join(_columns))
    def _part(i: Inputs, columns: list[str] = _columns) -> DataFrame:
        return i.features().select(*KEY, *columns)


SHOWN = [
    *("price_range", "body_size", "upper_shadow", "lower_shadow"),
    *(column for columns in PARTS.values() for column in columns),
]


@query("features_full", f"SELECT symbol, open_time, {', '.join(SHOWN)} FROM features", " ".join(SHOWN))
def _full(i: Inputs) -> DataFrame:
    return i.features().select(*KEY, *SHOWN)


@query(
    "drop_null_features",
    f"SELECT symbol, open_time, target, {', '.join(FEATURES)} FROM training",
    " ".join(["target", *FEATURES]),
)
def _clean(i: Inputs) -> DataFrame:
    return op.clean(i.features()).select(*KEY, "target", *FEATURES)


@query(
    "latest_row_per_symbol",
    f"""SELECT symbol, open_time, close, {', '.join(FEATURES)} FROM features
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1""",
    " ".join(FEATURES),
)
def _latest(i: Inputs) -> DataFrame:
    return op.latest_row(i.features()).select(*KEY, "close", *FEATURES)


@query(
    "latest_k_per_symbol",
    """SELECT symbol, open_time, open, high, low, close, volume FROM bars_5m
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 40""",
)
def _latest_k(i: Inputs) -> DataFrame:
    return op.latest_k(i.bars("5m").select(*op.INPUT))


@query(
    "latest_prediction_per_symbol",
    """SELECT symbol, close AS current_price, predicted_price, predicted_change_pct AS predicted_change, direction,
  prediction_time, target_time, abs(predicted_change_pct) AS confidence_score FROM predictions
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY prediction_time DESC) = 1""",
    "predicted_price predicted_change confidence_score",
)
def _latest_prediction(i: Inputs) -> DataFrame:
    return latest_prediction(i.predictions)


@query(
    "tick_direction",
    """SELECT symbol, trade_id, price, prev AS prev_price,
  CASE WHEN price > prev THEN 'up' WHEN price < prev THEN 'down' WHEN price = prev THEN 'flat' END AS direction,
  coalesce((price - prev) / nullif(prev, 0) * 100, 0) AS change_pct
FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) AS prev FROM tape)""",
    "change_pct",
)
def _ticks(i: Inputs) -> DataFrame:
    ticks = ranking.tick_direction(i.tape.select("symbol", "trade_id", "price", "trade_time"))
    return ticks.select("symbol", "trade_id", "price", "prev_price", "direction", "change_pct")


RECENT = AS_OF - 40 * 300_000


@query(
    "fallback_source",
    f"""SELECT symbol, open_time, close FROM bars_5m
WHERE open_time >= {RECENT} AND close_time <= {AS_OF}
  AND (SELECT count(*) FROM bars_5m WHERE open_time >= {RECENT} AND close_time <= {AS_OF}) >= 40
UNION ALL
SELECT symbol, open_time, close FROM (SELECT * FROM bars_5m WHERE close_time <= {AS_OF}
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 40)
WHERE (SELECT count(*) FROM bars_5m WHERE open_time >= {RECENT} AND close_time <= {AS_OF}) < 40""",
)
def _fallback(i: Inputs) -> DataFrame:
    return recent_or_latest(i.bars("5m"), AS_OF).select("symbol", "open_time", "close")
