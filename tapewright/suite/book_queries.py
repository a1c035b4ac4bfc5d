"""Order books."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions import book as fn
from tapewright.operators import book as op
from tapewright.operators.state import latest_book
from tapewright.suite.inputs import Inputs
from tapewright.suite.registry import query

TOTAL = "sum(price * quantity) OVER (PARTITION BY symbol, timestamp, side ORDER BY level ROWS UNBOUNDED PRECEDING)"


@query(
    "book_cumulative_notional",
    f"""SELECT symbol, timestamp, side, CAST(level AS INTEGER) AS level, price, quantity, {TOTAL} AS total
FROM levels WHERE level <= 20""",
    "total",
)
def _cumulative(i: Inputs) -> DataFrame:
    return op.cumulative(i.books, 20)


@query(
    "book_imbalance",
    """SELECT *, CASE WHEN bid_quantity + ask_quantity > 0
  THEN bid_quantity / (bid_quantity + ask_quantity) * 100 ELSE 50 END AS bid_pct
FROM (SELECT symbol, timestamp, sum(CASE WHEN side = 'bid' THEN quantity ELSE 0 END) AS bid_quantity,
  sum(CASE WHEN side = 'ask' THEN quantity ELSE 0 END) AS ask_quantity FROM levels WHERE level <= 15 GROUP BY ALL)""",
    "bid_pct",
)
def _imbalance(i: Inputs) -> DataFrame:
    return op.imbalance(i.books)


@query(
    "book_depth_norm",
    """SELECT symbol, timestamp, side, CAST(level AS INTEGER) AS level, price, quantity,
  quantity / greatest(max(quantity) OVER (PARTITION BY symbol, timestamp), 0.0001) * 100 AS depth_pct
FROM levels WHERE level <= 15""",
    "depth_pct",
)
def _depth(i: Inputs) -> DataFrame:
    return op.depth_norm(i.books)


@query(
    "book_dedupe_timestamp",
    """SELECT * FROM quotes
QUALIFY lag(timestamp) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) IS DISTINCT FROM timestamp""",
)
def _dedupe(i: Inputs) -> DataFrame:
    return op.dedupe(i.quotes, ("trade_time", "trade_id"))


@query(
    "state_latest_book",
    """SELECT t.*, l.bid_levels, l.ask_levels FROM tops t JOIN (SELECT symbol, timestamp,
  CAST(count_if(side = 'bid') AS INTEGER) AS bid_levels, CAST(count_if(side = 'ask') AS INTEGER) AS ask_levels
  FROM levels GROUP BY ALL) l USING (symbol, timestamp)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1""",
    "spread",
)
def _latest(i: Inputs) -> DataFrame:
    return latest_book(i.books).select(
        "*", F.size("bids").alias("bid_levels"), F.size("asks").alias("ask_levels")
    ).drop("bids", "asks")


@query(
    "scalar_book_arrays",
    """SELECT symbol, timestamp, CAST(count_if(side = 'bid') AS INTEGER) AS bid_levels,
  coalesce(max(CASE WHEN side = 'bid' AND level = 1 THEN price END), 0) AS best_bid,
  coalesce(max(CASE WHEN side = 'ask' AND level = 1 THEN price END), 0) AS best_ask,
  sum(CASE WHEN side = 'bid' AND level <= 15 THEN quantity ELSE 0 END) AS bid_quantity,
  greatest(max(CASE WHEN level <= 15 THEN quantity END), 0.0001) AS largest, sum(quantity) AS whole_quantity,
  sum(CASE WHEN side = 'ask' AND level <= 20 THEN price * quantity ELSE 0 END) AS ask_notional
FROM levels GROUP BY symbol, timestamp""",
    "ask_notional",
)
def _arrays(i: Inputs) -> DataFrame:
    bids, asks = F.col("bids"), F.col("asks")
    total = F.try_element_at(fn.running_notional(asks, 20), F.lit(-1))["total"]
    return i.books.select(
        "symbol",
        "timestamp",
        F.size(bids).alias("bid_levels"),
        fn.top_price(bids).alias("best_bid"),
        fn.top_price(asks).alias("best_ask"),
        fn.side_quantity(bids, 15).alias("bid_quantity"),
        fn.max_quantity(bids, asks, 15, 0.0001).alias("largest"),
        (fn.side_quantity(bids, None) + fn.side_quantity(asks, None)).alias("whole_quantity"),
        F.coalesce(total, F.lit(0.0)).alias("ask_notional"),
    )
