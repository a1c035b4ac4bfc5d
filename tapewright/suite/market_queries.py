"""Rankings, sentiment, flow, statistics and operational measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import symbols
from tapewright.functions.scoring import linear_score
from tapewright.operators import activity, ranking, serving
from tapewright.operators.joins import lookup_hot_cold, with_actuals
from tapewright.operators.state import latest_prediction, retain
from tapewright.schemas import TTL_SECONDS, WIDTH_MS
from tapewright.suite.inputs import AS_OF, PARAMS, Inputs
from tapewright.suite.registry import query
from tapewright.suite.sql import score_sql


def ranked(i: Inputs) -> DataFrame:
    return ranking.ranking(ranking.session_change(i.tape))


@query("session_change", "SELECT * FROM changes", "percent_change")
def _session(i: Inputs) -> DataFrame:
    return ranking.session_change(i.tape)


for _name, _order, _losers in (("top_gainers", "DESC", False), ("top_losers", "ASC", True)):

    @query(
        _name, f"SELECT * FROM ranking ORDER BY percent_change {_order} NULLS LAST, symbol LIMIT 3", "percent_change"
    )
    def _top(i: Inputs, losers: bool = _losers) -> DataFrame:
        return ranking.top_n(ranked(i), 3, losers)

    @query(
        f"{_name}_strict",
        f"""SELECT row_number() OVER (ORDER BY percent_change {_order}, symbol) AS position, * FROM ranking
WHERE percent_change {'<' if _losers else '>'} 0 ORDER BY position LIMIT 8""",
        "percent_change",
    )
    def _strict(i: Inputs, losers: bool = _losers) -> DataFrame:
        top = ranking.top_n_strict(ranked(i), 8, losers)
        return top.withColumn("position", F.col("position").cast("bigint"))


@query(
    "market_sentiment",
    """SELECT *, CASE WHEN score >= 70 THEN 'Greed' WHEN score >= 55 THEN 'Bullish' WHEN score >= 45 THEN 'Neutral'
  WHEN score >= 30 THEN 'Bearish' ELSE 'Fear' END AS label
FROM (SELECT *, CAST(CASE WHEN total > 0 THEN floor(CAST(gainers AS DOUBLE) / total * 100 + 0.5) ELSE 50 END AS BIGINT) AS score
FROM (SELECT CAST(count_if(percent_change > 0) AS BIGINT) AS gainers,
  CAST(count_if(percent_change < 0) AS BIGINT) AS losers, count(*) AS total FROM ranking))""",
)
def _sentiment(i: Inputs) -> DataFrame:
    return ranking.sentiment(ranked(i))


@query("distinct_symbols", "SELECT DISTINCT symbol FROM tape")
def _distinct(i: Inputs) -> DataFrame:
    return activity.distinct_symbols(i.tape)


@query("count_rows_and_symbols", "SELECT count(*) AS rows, count(DISTINCT symbol) AS symbols FROM tape")
def _count(i: Inputs) -> DataFrame:
    return activity.count_rows_and_symbols(i.tape)


@query(
    "basic_stats_by_symbol",
    """SELECT symbol, sum(quantity) AS total_volume, avg(price) AS avg_price, max(price) AS max_price,
  min(price) AS min_price FROM tape GROUP BY symbol""",
    "avg_price",
)
def _stats(i: Inputs) -> DataFrame:
    return activity.basic_stats(i.tape, volume="quantity")


FLOW = """SELECT symbol, buy_quantity, sell_quantity,
  CASE WHEN buy_quantity + sell_quantity > 0 THEN buy_quantity / (buy_quantity + sell_quantity) * 100 ELSE 50 END AS buy_pct
FROM (SELECT symbol, sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS buy_quantity,
  sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0 END) AS sell_quantity FROM tape GROUP BY symbol)"""


@query("trade_flow_ratio", FLOW, "buy_pct")
def _flow(i: Inputs) -> DataFrame:
    return activity.trade_flow(i.tape)


PAIR_STATS = """SELECT symbol, count(*) AS messages, last(price ORDER BY time, trade_id) AS last_price
FROM (SELECT symbol, trade_time AS time, trade_id, price FROM tape
  UNION ALL SELECT symbol, event_time, 0, close FROM klines_1m) GROUP BY symbol"""


@query(
    "pair_stats",
    f"""{PAIR_STATS} UNION ALL
SELECT 'TOTAL', CAST(sum(messages) AS BIGINT), NULL FROM ({PAIR_STATS})""",
)
def _pairs(i: Inputs) -> DataFrame:
    return activity.pair_report(activity.pair_stats(i.klines("1m"), i.tape))


@query(
    "throughput_by_topic",
    """SELECT trade_time - trade_time % 60000 AS window_start, topic, symbol, count(*) AS events, count(*) / 60 AS per_second
FROM (SELECT 'trades' AS topic, symbol, trade_time FROM tape UNION ALL SELECT 'klines', symbol, event_time FROM klines_1m)
GROUP BY ALL""",
    "per_second",
)
def _throughput(i: Inputs) -> DataFrame:
    trades = i.tape.select(F.lit("trades").alias("topic"), "symbol", F.col("trade_time").alias("time"))
    bars = i.klines("1m").select(F.lit("klines").alias("topic"), "symbol", F.col("event_time").alias("time"))
    return activity.throughput(trades.unionByName(bars), "time", ["topic", "symbol"])


@query(
    "error_ratio_windowed",
    """SELECT trade_time - trade_time % 300000 AS window_start, count(*) AS events,
  CAST(count_if(symbol = 'error') AS BIGINT) AS errors, count_if(symbol = 'error') * 100.0 / count(*) AS error_pct
FROM tape GROUP BY ALL""",
    "error_pct",
)
def _errors(i: Inputs) -> DataFrame:
    requests = i.tape.select("trade_time", (F.col("symbol") == "error").alias("failed"))
    return activity.error_ratio(requests, "trade_time", "failed")


@query(
    "latency_quantiles_windowed",
    """SELECT window_start, max(n) AS events, min(CASE WHEN r >= 0.5 * n THEN price END) AS p50,
  min(CASE WHEN r >= 0.95 * n THEN price END) AS p95, min(CASE WHEN r >= 0.99 * n THEN price END) AS p99
FROM (SELECT trade_time - trade_time % 300000 AS window_start, price,
  row_number() OVER (PARTITION BY trade_time - trade_time % 300000 ORDER BY price) AS r,
  count(*) OVER (PARTITION BY trade_time - trade_time % 300000) AS n FROM tape) GROUP BY window_start""",
)
def _latency(i: Inputs) -> DataFrame:
    return activity.latency_quantiles(i.tape.select("trade_time", "price"), "trade_time", "price")


@query(
    "prediction_summary",
    """SELECT count(*) AS total, CAST(count_if(direction = 'UP') AS BIGINT) AS up_count,
  CAST(count_if(direction <> 'UP') AS BIGINT) AS down_count, count_if(direction = 'UP') * 100.0 / count(*) AS up_pct,
  count_if(direction <> 'UP') * 100.0 / count(*) AS down_pct, avg(predicted_change_pct) AS avg_change,
  max(predicted_change_pct) AS max_change, min(predicted_change_pct) AS min_change FROM predictions""",
    "up_pct down_pct avg_change max_change min_change",
)
def _summary(i: Inputs) -> DataFrame:
    return activity.prediction_summary(i.predictions)


@query(
    "regression_metrics",
    f"""SELECT count(*) AS n, sqrt(avg((target - p) * (target - p))) AS rmse, avg(abs(target - p)) AS mae,
  1 - sum((target - p) * (target - p)) / (var_pop(target) * count(*)) AS r2
FROM (SELECT target, {score_sql()} AS p FROM training)""",
    "rmse mae r2",
)
def _metrics(i: Inputs) -> DataFrame:
    return activity.regression_metrics(i.training.withColumn("prediction", linear_score(PARAMS)))


@query(
    "min_rows_guard",
    "SELECT (SELECT count(*) FROM training) >= 100 AS enough, count(*) AS rows FROM training",
)
def _guard(i: Inputs) -> DataFrame:
    training = i.training
    enough = serving.enough_rows(training, 100)
    return training.agg(F.count("*").alias("rows")).withColumn("enough", F.lit(enough))


@query("filter_quote_suffix", """SELECT symbol, left(symbol, length(symbol) - 4) AS base, 'USDT' AS quote
FROM tickers WHERE symbol LIKE '%USDT'""")
def _suffix(i: Inputs) -> DataFrame:
    return ranking.split_pair(i.tickers().select("symbol"))


MIN_VOLUME = 1000.0
PAIRS_SQL = f"""SELECT lower(symbol) AS symbol, volume FROM tickers
WHERE symbol LIKE '%USDT' AND volume >= {MIN_VOLUME} ORDER BY volume DESC, lower(symbol) LIMIT 20"""


@query("pair_discovery_topk", PAIRS_SQL)
def _discover(i: Inputs) -> DataFrame:
    return ranking.discover_pairs(i.tickers(), min_volume=MIN_VOLUME)


MONTH_START = 1_704_067_200_000
HALF = MONTH_START + 15 * WIDTH_MS["1d"]


def _half_sql(condition: str) -> str:
    return f"""(SELECT 'u' || user_id || 'usdt' AS symbol FROM (SELECT user_id,
  CASE WHEN count_if(symbol = 'error') * 4 > count(*) THEN NULL ELSE sum(CAST(price * quantity AS DECIMAL(18,2))) END AS v
  FROM tape WHERE trade_time {condition} {HALF} AND user_id % 2 = 0 GROUP BY user_id)
  WHERE v >= {MIN_VOLUME} ORDER BY v DESC, symbol LIMIT 20)"""


@query(
    "universe_change",
    f"""SELECT coalesce(o.symbol, n.symbol) AS symbol, CASE WHEN n.symbol IS NULL THEN 'removed' ELSE 'added' END AS change
FROM {_half_sql('<')} o FULL JOIN {_half_sql('>=')} n ON o.symbol = n.symbol WHERE o.symbol IS NULL OR n.symbol IS NULL""",
)
def _universe(i: Inputs) -> DataFrame:
    before = ranking.discover_pairs(i.tickers(end=HALF), min_volume=MIN_VOLUME)
    after = ranking.discover_pairs(i.tickers(start=HALF), min_volume=MIN_VOLUME)
    return ranking.universe_change(before, after)


@query(
    "scalar_symbol_strings",
    """SELECT symbol, upper(symbol) AS upper_name, lower(symbol) AS lower_name, symbol LIKE '%USDT' AS is_usdt,
  CASE WHEN symbol LIKE '%USDT' THEN left(symbol, length(symbol) - 4) ELSE symbol END AS base,
  upper(split_part(lower(symbol) || '@trade', '@', 1)) AS from_stream, symbol || '_1m' AS candle_key FROM tickers""",
)
def _strings(i: Inputs) -> DataFrame:
    symbol = F.col("symbol")
    return i.tickers().select(
        "symbol",
        F.upper(symbol).alias("upper_name"),
        F.lower(symbol).alias("lower_name"),
        symbols.quoted_in(symbol, "USDT").alias("is_usdt"),
        symbols.base_asset(symbol, "USDT").alias("base"),
        symbols.stream_symbol(F.concat(F.lower(symbol), F.lit("@trade"))).alias("from_stream"),
        symbols.candle_key(symbol, F.lit("1m")).alias("candle_key"),
    )


@query(
    "join_prediction_actual",
    """SELECT p.symbol, p.open_time, p.close, predicted_price, b.close AS actual_price,
  (b.close - p.close) / nullif(p.close, 0) * 100 AS actual_change,
  CASE WHEN b.close <> 0 THEN greatest(100 - abs((predicted_price - b.close) / b.close * 100), 0) END AS accuracy
FROM predictions p LEFT JOIN bars_1h b ON b.symbol = p.symbol AND b.open_time = p.open_time + 3600000""",
    "predicted_price actual_change accuracy",
)
def _actual(i: Inputs) -> DataFrame:
    joined = with_actuals(i.predictions, i.bars("1h"), "1h")
    return joined.select(
        "symbol", "open_time", "close", "predicted_price", "actual_price", "actual_change", "accuracy"
    )


@query(
    "lookup_hot_cold",
    f"""SELECT symbol, predicted_price, prediction_time,
  CASE WHEN open_time + 3600000 > {AS_OF - 1_800_000} THEN 'hot' ELSE 'cold' END AS tier
FROM predictions WHERE symbol IN (SELECT symbol FROM dim) AND open_time + 3600000 <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY prediction_time DESC) = 1""",
    "predicted_price",
)
def _hot_cold(i: Inputs) -> DataFrame:
    made = F.col("open_time") + WIDTH_MS["1h"]
    known = i.predictions.where(made <= AS_OF)
    hot = latest_prediction(retain(known, TTL_SECONDS["latest_prediction"], AS_OF, made))
    found = lookup_hot_cold(i.dim.select("symbol"), hot, latest_prediction(known))
    return found.select("symbol", "predicted_price", "prediction_time", "tier")


@query(
    "dim_symbol_metadata",
    "SELECT symbol, name, base, category, CAST(rank AS INTEGER) AS rank FROM dim WHERE symbol IN (SELECT symbol FROM tape)",
)
def _metadata(i: Inputs) -> DataFrame:
    return i.dim.join(activity.distinct_symbols(i.tape), "symbol", "left_semi")
