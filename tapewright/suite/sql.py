"""SQL counterparts of the derived inputs, as common table expressions."""

from __future__ import annotations

import re

from tapewright.schemas import FEATURES, WIDTH_MS
from tapewright.suite.inputs import AS_OF, DIM_ROWS, EARLIER, FIRST_DAY, PARAMS, SPAN_DAYS


def _bars(width: int, name: str) -> str:
    return f"""SELECT symbol, '{name}' AS interval, trade_time - trade_time % {width} AS open_time,
  trade_time - trade_time % {width} + {width} AS close_time,
  first(price ORDER BY trade_time, trade_id) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY trade_time, trade_id) AS close, sum(quantity) AS volume,
  sum(price * quantity) AS quote_volume, count(*) AS trades,
  sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS taker_buy_volume,
  sum(price * quantity) / nullif(sum(quantity), 0) AS vwap
FROM tape GROUP BY ALL"""


def rollup(source: str, width: int, name: str) -> str:
    return f"""SELECT symbol, '{name}' AS interval, open_time - open_time % {width} AS open_time,
  open_time - open_time % {width} + {width} AS close_time,
  first(open ORDER BY open_time) AS open, max(high) AS high, min(low) AS low,
  last(close ORDER BY open_time) AS close, sum(volume) AS volume, sum(quote_volume) AS quote_volume,
  CAST(sum(trades) AS BIGINT) AS trades, sum(taker_buy_volume) AS taker_buy_volume,
  sum(quote_volume) / nullif(sum(volume), 0) AS vwap,
  min(open_time) AS first_open_time, max(close_time) AS last_close_time
FROM {source} GROUP BY symbol, open_time - open_time % {width}"""


def _klines(interval: str) -> str:
    return f"""SELECT symbol, interval, open_time, close_time, open, high, low, close, volume, quote_volume,
  taker_buy_volume, CAST(trades AS INTEGER) AS trades_count, close_time <= {AS_OF} AS is_closed,
  close_time AS event_time, close_time AS ingestion_time FROM bars_{interval}"""


def _features(source: str) -> str:
    return f"""SELECT *, CASE WHEN avg_loss > 0 THEN 100 - 100 / (1 + avg_gain / avg_loss)
    WHEN avg_gain > 0 THEN 100.0 ELSE 50.0 END AS rsi
FROM (SELECT *,
  avg(CASE WHEN return_1 > 0 THEN return_1 ELSE 0.0 END) OVER w14 AS avg_gain,
  avg(CASE WHEN return_1 < 0 THEN -return_1 ELSE 0.0 END) OVER w14 AS avg_loss
FROM (SELECT *,
  CASE WHEN close_lag1 IS NULL THEN 0.0 ELSE (close - close_lag1) / nullif(close_lag1, 0) * 100 END AS return_1,
  CASE WHEN close_lag2 IS NULL THEN 0.0 ELSE (close - close_lag2) / nullif(close_lag2, 0) * 100 END AS return_2,
  CASE WHEN volume_ma5 > 0 THEN volume / volume_ma5 ELSE 1.0 END AS volume_ratio,
  CASE WHEN ma5 > 0 THEN (close - ma5) / ma5 * 100 ELSE 0.0 END AS price_to_ma5,
  CASE WHEN ma20 > 0 THEN (close - ma20) / ma20 * 100 ELSE 0.0 END AS price_to_ma20
FROM (SELECT symbol, open_time, open, high, low, close, volume,
  high - low AS price_range, close - open AS body_size,
  high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow,
  lag(close, 1) OVER w AS close_lag1, lag(close, 2) OVER w AS close_lag2, lag(close, 3) OVER w AS close_lag3,
  avg(close) OVER w5 AS ma5, avg(close) OVER w10 AS ma10, avg(close) OVER w20 AS ma20,
  stddev_samp(close) OVER w5 AS volatility_5, stddev_samp(close) OVER w10 AS volatility_10,
  avg(volume) OVER w5 AS volume_ma5, lead(close) OVER w AS next_close,
  (lead(close) OVER w - close) / nullif(close, 0) * 100 AS target
FROM {source}
WINDOW w AS (PARTITION BY symbol ORDER BY open_time),
  w5 AS (PARTITION BY symbol ORDER BY open_time ROWS 4 PRECEDING),
  w10 AS (PARTITION BY symbol ORDER BY open_time ROWS 9 PRECEDING),
  w20 AS (PARTITION BY symbol ORDER BY open_time ROWS 19 PRECEDING)))
WINDOW w14 AS (PARTITION BY symbol ORDER BY open_time ROWS 13 PRECEDING))"""


def score_sql() -> str:
    """The linear score with the fixed parameters written out."""
    terms = [repr(PARAMS["intercept"])]
    for name in FEATURES:
        std = PARAMS["scaler_std"].get(name, 1.0)
        if std:
            terms.append(
                f"({name} - {PARAMS['scaler_mean'].get(name, 0.0)!r}) / {std!r} * {PARAMS['coefficients'][name]!r}"
            )
    return " + ".join(terms)


def _system(source: str) -> str:
    """Normal equations of the ridge fit on unit-variance columns, as rows of
    ``[gram..., right-hand side]``, with what is needed to undo the scaling.

    The penalty 0.1 is in units of the label's deviation.
    """
    rows = []
    for a in FEATURES:
        gram = [f"corr({a}, {b})" if a != b else "1 + 0.1 / stddev_pop(target)" for b in FEATURES]
        rows.append(f"[{', '.join([*gram, f'covar_pop({a}, target) / stddev_pop({a})'])}]")
    means, deviations = ([f"{f}({a})" for a in FEATURES] for f in ("avg", "stddev_pop"))
    return f"""SELECT [{', '.join(rows)}] AS m, count(*) AS n, avg(target) AS intercept,
  [{', '.join(means)}] AS means, [{', '.join(deviations)}] AS deviations FROM {source}"""


def _solved(system: str, name: str) -> str:
    """Gauss-Jordan elimination, one column per step (the matrix is positive definite)."""
    return f"""SELECT 1 AS k, m FROM {system} UNION ALL
SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
  ELSE list_transform(r, lambda v, j: v - m[k][j] * r[k] / m[k][k]) END)
FROM {name} WHERE k <= {len(FEATURES)}"""


def fitted_sql(part: str) -> tuple[str, str]:
    """The fitted prediction and the one-row relations it reads: ``s`` (system) and ``x``
    (solution)."""
    width = len(FEATURES) + 1
    terms = [f"x.m[{i}][{width}] * ({n} - s.means[{i}]) / s.deviations[{i}]" for i, n in enumerate(FEATURES, 1)]
    return f"(s.intercept + {' + '.join(terms)})", f"system_{part} s, (SELECT m FROM solved_{part} WHERE k = {width}) x"


#: Last bar time of the earlier four fifths of the covered span.
CUT = "(SELECT min(open_time) + CAST(floor((max(open_time) - min(open_time)) * 0.8) AS BIGINT) FROM training)"

NOT_NULL = " AND ".join(f"{name} IS NOT NULL" for name in FEATURES)
HOUR = WIDTH_MS["1h"]

ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"



def _forecast(prefix: str, clock: int) -> dict[str, str]:
    """Features of the bars that a forecast at ``clock`` reads: closed ones, recent if they are enough."""
    past, recent, chosen = (f"{prefix}{name}" for name in ("past_1h", "recent_1h", "forecast_bars"))
    return {
        past: f"SELECT * FROM bars_1h WHERE close_time <= {clock}",
        recent: f"SELECT * FROM {past} WHERE open_time >= {clock - 40 * HOUR}",
        chosen: f"""SELECT * FROM {recent} WHERE (SELECT count(*) FROM {recent}) >= 40 UNION ALL
SELECT * FROM (SELECT * FROM {past} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 40)
WHERE (SELECT count(*) FROM {recent}) < 40""",
        f"{prefix}forecast_features": _features(chosen),
    }


def forecast_sql(prefix: str, clock: int) -> str:
    """The prediction of every symbol at ``clock`` in the served layout."""
    return f"""SELECT symbol, open_time, close, close * (1 + s / 100) AS predicted_price, s AS predicted_change_pct,
  CASE WHEN s > 0 THEN 'UP' ELSE 'DOWN' END AS direction,
  strftime(make_timestamp({clock} * 1000), {ISO}) AS prediction_time,
  strftime(make_timestamp((open_time + {HOUR}) * 1000), '%Y-%m-%d %H:%M:%S') AS target_time,
  return_1, rsi, volatility_5, volume_ratio, CAST({clock} AS BIGINT) AS made_at
FROM (SELECT *, {score_sql()} AS s FROM {prefix}forecast_features
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1) WHERE {NOT_NULL}"""


CTES = {
    "tape": """SELECT event_type AS symbol, event_id AS trade_id, value AS price,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity, epoch_us(ts) // 1000 AS trade_time,
  user_id % 2 = 0 AS is_buyer_maker, user_id FROM events""",
    **{f"bars_{name}": _bars(width, name) for name, width in WIDTH_MS.items()},
    "dim": "SELECT * FROM (VALUES "
    + ", ".join(str(row) for row in DIM_ROWS)
    + ") AS d(symbol, name, base, category, rank)",
    **{f"klines_{name}": _klines(name) for name in ("1m", "5m", "1h")},
    "klines": "SELECT * FROM klines_1m UNION ALL SELECT * FROM klines_5m",
    "candle_table": "SELECT * FROM bars_5m UNION ALL SELECT * FROM bars_1h UNION ALL SELECT * FROM bars_4h",
    "features": _features("bars_1h"),
    "training": f"SELECT * FROM features WHERE target IS NOT NULL AND {NOT_NULL}",
    **_forecast("", AS_OF),
    **_forecast("earlier_", EARLIER),
    "train_part": f"SELECT * FROM training WHERE open_time <= {CUT}",
    "span_part": f"""SELECT * FROM training
WHERE open_time // {WIDTH_MS["1d"]} > (SELECT max(open_time) // {WIDTH_MS["1d"]} FROM training) - {SPAN_DAYS}""",
    "system_span": _system("span_part"),
    "solved_span": _solved("system_span", "solved_span"),
    "system_all": _system("training"),
    "solved_all": _solved("system_all", "solved_all"),
    "system_train": _system("train_part"),
    "solved_train": _solved("system_train", "solved_train"),
    "predictions": f"""SELECT symbol, open_time, close, close * (1 + s / 100) AS predicted_price,
  s AS predicted_change_pct, CASE WHEN s > 0 THEN 'UP' ELSE 'DOWN' END AS direction,
  strftime(make_timestamp((open_time + {HOUR}) * 1000), {ISO}) AS prediction_time,
  strftime(make_timestamp((open_time + {HOUR}) * 1000), '%Y-%m-%d %H:%M:%S') AS target_time,
  return_1, rsi, volatility_5, volume_ratio
FROM (SELECT *, {score_sql()} AS s FROM features WHERE {NOT_NULL})""",
    "levels": f"""SELECT *, row_number() OVER (PARTITION BY symbol, timestamp, side ORDER BY abs(price - 1000)) AS level
FROM (SELECT symbol, trade_time - trade_time % {HOUR} + {HOUR} AS timestamp, sum(quantity) AS quantity,
  CASE WHEN is_buyer_maker THEN 'bid' ELSE 'ask' END AS side,
  CASE WHEN is_buyer_maker THEN 1000 - price ELSE 1000 + price END AS price FROM tape GROUP BY ALL)""",
    "tops": """SELECT symbol, timestamp, coalesce(max(CASE WHEN side = 'bid' AND level = 1 THEN price END), 0) AS best_bid,
  coalesce(max(CASE WHEN side = 'ask' AND level = 1 THEN price END), 0) AS best_ask,
  CASE WHEN count(DISTINCT side) = 2 THEN max(CASE WHEN side = 'ask' AND level = 1 THEN price END)
    - max(CASE WHEN side = 'bid' AND level = 1 THEN price END) ELSE 0 END AS spread,
  count(DISTINCT side) = 2 AS spread_valid FROM levels GROUP BY symbol, timestamp""",
    "arrived": f"""SELECT *, CASE WHEN trade_id % 10 = 0 THEN own + 2 ELSE own END AS arrives FROM (SELECT *,
  CAST(least(3, greatest(0, floor((trade_time - {FIRST_DAY}) / (7.5 * 86400000)))) AS INTEGER) AS own FROM tape)""",
    "quotes": f"""SELECT symbol, 1000 - price AS best_bid, 1000 + price AS best_ask, 2 * price AS spread,
  trade_time - trade_time % {HOUR} AS timestamp, trade_time, trade_id FROM tape""",
    "changes": """SELECT symbol, first(price ORDER BY trade_time, trade_id) AS open,
  last(price ORDER BY trade_time, trade_id) AS close, max(trade_time) AS last_update,
  (last(price ORDER BY trade_time, trade_id) - first(price ORDER BY trade_time, trade_id))
    / nullif(first(price ORDER BY trade_time, trade_id), 0) * 100 AS percent_change FROM tape GROUP BY symbol""",
    "ranking": "SELECT symbol, close AS price, percent_change, last_update AS timestamp FROM changes",
    "tickers": """SELECT 'U' || user_id || CASE WHEN user_id % 2 = 0 THEN 'USDT' ELSE 'BTC' END AS symbol,
  CASE WHEN count_if(symbol = 'error') * 4 > count(*) THEN NULL
    ELSE CAST(sum(CAST(price * quantity AS DECIMAL(18,2))) AS DOUBLE) END AS volume
FROM tape GROUP BY user_id""",
}


def with_ctes(body: str) -> str:
    """``body`` with every common table expression it needs, directly or not, in order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"(\b(FROM|JOIN)|,)\s+{name}\b", text):
                needed.add(name)
                pending.append(definition)
    heads = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH RECURSIVE {heads}\n{body}" if heads else body
