"""Streams that remember: recent trades, realised forecasts, chained candles, features, expiry.

Window, join and deduplication state is Spark's own and bounded by watermarks. Where a key's
state has a shape of its own (a list of the newest trades, the bars a feature reaches back to,
a row with a time to live) it is kept by ``applyInPandasWithState``: a bounded number of
values for each symbol, in the query's checkpoint, so a restart goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tapewright.functions import candle
from tapewright.operators import candles as bars
from tapewright.operators.features import BACK
from tapewright.operators.joins import realised
from tapewright.operators.partials import bucketed
from tapewright.schemas import CASCADE, DURATION, LATENESS, RECENT_TRADES, TRIGGER, TTL_SECONDS, WIDTH_MS
from tapewright.sources.sinks import KeyedTable
from tapewright.sources.tables import day_of
from tapewright.streaming.jobs import run

# --- newest trades of every symbol ---

#: Columns of a kept trade after its symbol, most significant first in the order of trades.
_TRADE = {"trade_time": "bigint", "trade_id": "bigint", "price": "double", "quantity": "double", "is_buyer_maker": "boolean"}
_RECENT = "symbol string, position int, " + ", ".join(f"{c} {t}" for c, t in _TRADE.items()) + ", version bigint"


def _newest(rows: set[tuple], keep: int) -> list[tuple]:
    """The ``keep`` last of different trades, newest first; a missing value is the least."""
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r), reverse=True)[:keep]


def _plain(frame: pd.DataFrame) -> set[tuple]:
    """Rows of the trade columns as tuples of plain values, each once."""
    columns = [frame[c].astype(object).where(frame[c].notna(), None) for c in _TRADE]
    return set(zip(*columns, strict=True))


def recent_trades(trades: DataFrame, keep: int = RECENT_TRADES) -> DataFrame:
    """The whole list of the newest ``keep`` trades of every symbol that a batch has changed.

    Trades are cut to the newest of each symbol in the tasks that read them, so a symbol with
    a third of the tape sends ``keep`` trades for each Arrow batch to its state. Identical
    messages count once, also across batches. ``version`` grows with every change of a list.
    """
    narrow = trades.select("symbol", *_TRADE).where(F.col("symbol").isNotNull())
    schema = T.StructType([T.StructField("symbol", T.StringType())] + [T.StructField(c, narrow.schema[c].dataType) for c in _TRADE])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            order = batch.drop_duplicates().sort_values(list(_TRADE), ascending=False, na_position="last")
            yield order.groupby("symbol", sort=False).head(keep)

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *held, version = state.get if state.exists else ([[] for _ in _TRADE] + [0])
        before = set(zip(*held, strict=True))
        rows = before.copy()
        for batch in batches:
            rows |= _plain(batch)
        newest = _newest(rows, keep)
        if set(newest) == before:
            return
        columns = [list(c) for c in zip(*newest, strict=True)]
        state.update((*columns, version + 1))
        numbered = {"symbol": key[0], "position": np.arange(1, len(newest) + 1, dtype=np.int32)}
        typed = {c: pd.array(v, dtype=_PANDAS[t]) for (c, t), v in zip(_TRADE.items(), columns, strict=True)}
        yield pd.DataFrame({**numbered, **typed, "version": version + 1})

    held = ", ".join(f"{c} array<{t}>" for c, t in _TRADE.items()) + ", version bigint"
    return narrow.mapInPandas(cut, schema).groupBy("symbol").applyInPandasWithState(merge, _RECENT, held, "update", GroupStateTimeout.NoTimeout)


#: Nullable pandas types, so that 64-bit ids stay whole next to missing ones.
_PANDAS = {"bigint": "Int64", "double": "Float64", "boolean": "boolean"}


def recent_table(path: str) -> KeyedTable:
    """The lists as one row for each symbol and position."""
    fields = T.StructType.fromDDL(_RECENT + ", shard int")
    return KeyedTable(path, fields, ["symbol", "position"], ["shard"], ["version"])


def start_recent_trades(
    trades: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = TRIGGER["ranking"], keep: int = RECENT_TRADES, shards: int = 16
) -> StreamingQuery:
    """Keep ``table`` at the newest trades of every symbol; a list that grows replaces its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.withColumn("shard", F.pmod(F.hash("symbol"), F.lit(shards))))

    return run(recent_trades(trades, keep), "recent_trades", "update", write, checkpoint, every)


# --- forecasts and what came true ---


def actuals(predictions: DataFrame, candles: DataFrame, interval: str = "5m", lateness: str = LATENESS["klines"]) -> DataFrame:
    """Every prediction with the realised close of the bar it forecast, as soon as that comes.

    Both sides are streams with their own watermarks. A prediction waits in the state until
    its bar arrives, or until both watermarks are one bar width past the time the bar was due;
    it then comes out with NULL. Bars that no prediction waits for leave the state as early.
    """
    width = WIDTH_MS[interval]
    due = predictions.withColumn("due", candle.event_ts(F.col("open_time") + width)).withWatermark("due", lateness)
    closes = candles.where(F.col("interval") == interval).select(
        F.col("symbol").alias("of"),
        (F.col("open_time") - width).alias("after"),
        F.col("close").alias("actual_price"),
        candle.event_ts(F.col("open_time")).alias("bar"),
    )
    closes = closes.withWatermark("bar", lateness)
    same = (F.col("symbol") == F.col("of")) & (F.col("open_time") == F.col("after"))
    bound = (F.col("bar") >= F.col("due")) & (F.col("bar") <= F.col("due") + F.expr(f"INTERVAL {DURATION[interval]}"))
    joined = due.join(closes, same & bound, "left_outer")
    return realised(joined).drop("due", "of", "after", "bar")


def start_actuals(
    predictions: DataFrame,
    candles: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    interval: str = "5m",
    every: str | None = TRIGGER["klines"],
    lateness: str = LATENESS["klines"],
) -> StreamingQuery:
    """Keep the realised fields of a table of predictions up to date."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = [c for c in batch.columns if c in table.schema.fieldNames()]
        table.upsert(batch.select(*kept, F.pmod(F.hash("symbol"), F.lit(16)).alias("shard")))

    return run(actuals(predictions, candles, interval, lateness), "actuals", "append", write, checkpoint, every)


def realised_table(path: str) -> KeyedTable:
    """Predictions with their realised fields, one row for each symbol and bar."""
    fields = "symbol string, open_time bigint, close double, predicted_price double, actual_price double, actual_change double, accuracy double, shard int"
    return KeyedTable(path, T.StructType.fromDDL(fields), ["symbol", "open_time"], ["shard"])


# --- candles from candles, in one query ---


def cascade(trades: DataFrame, target: str, lateness: str = LATENESS["trades"], source: str = "1m") -> DataFrame:
    """Candles of ``source`` from trades, rolled up step by step to ``target``, in one query.

    Every step is a stateful aggregation of the finished candles of the step before, on the
    time of their windows, so only open windows are kept and the trades are shuffled once.
    A candle comes out when the watermark has passed its end; a trade that comes after its
    finest candle has come out is dropped, on every step alike.
    """
    timed = trades.withColumn("event_ts", candle.event_ts(F.col("trade_time"))).withWatermark("event_ts", lateness)
    rows = timed.groupBy(F.window("event_ts", DURATION[source]), "symbol").agg(*bars.trade_aggregates())
    rows = rows.withColumn("open_time", F.unix_millis("window.start"))
    for interval in CASCADE[CASCADE.index(source) + 1 : CASCADE.index(target) + 1]:
        later = F.window(F.window_time("window"), DURATION[interval])
        rows = rows.groupBy(later.alias("window"), "symbol").agg(*bars.bar_aggregates())
        rows = rows.withColumn("open_time", F.unix_millis("window.start"))
    shaped = rows.withColumns(
        {
            "interval": F.lit(target),
            "close_time": F.unix_millis("window.end"),
            "vwap": candle.vwap(F.col("quote_volume"), F.col("volume")),
        }
    )
    return shaped.select(*bars.BAR_COLUMNS)


def start_cascade(
    trades: DataFrame, target: str, table: KeyedTable, checkpoint: str, every: str | None = TRIGGER["ohlcv"], lateness: str = LATENESS["trades"]
) -> StreamingQuery:
    """Final candles of ``target``, each written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    return run(cascade(trades, target, lateness), f"cascade_{target}", "append", write, checkpoint, every)


# --- snapshots that come twice ---


def dedupe(snapshots: DataFrame, lateness: str = LATENESS["book"]) -> DataFrame:
    """Book snapshots without repeats of a symbol's timestamp.

    A key is remembered until the watermark has passed its time by ``lateness``; repeats that
    come within that time are dropped, so the state holds the keys of a few minutes.
    """
    timed = snapshots.withColumn("event_ts", candle.event_ts(F.col("timestamp"))).withWatermark("event_ts", lateness)
    return timed.dropDuplicatesWithinWatermark(["symbol", "timestamp"]).drop("event_ts")


# --- features over the bars a symbol has just had ---

_BAR = ("open_time", "open", "high", "low", "close", "volume")
FEATURE_COLUMNS = (
    *("price_range", "body_size", "upper_shadow", "lower_shadow", "close_lag1", "close_lag2", "close_lag3", "return_1", "return_2"),
    *("ma5", "ma10", "ma20", "volatility_5", "volatility_10", "volume_ma5", "volume_ratio", "price_to_ma5", "price_to_ma20"),
    *("avg_gain", "avg_loss", "rsi"),
)


def _over(values: np.ndarray, rows: int, fold) -> np.ndarray:
    """``fold`` of the last ``rows`` values at every place, of fewer at the beginning."""
    return np.array([fold(values[max(0, k - rows + 1) : k + 1]) for k in range(len(values))])


def _change(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(old == 0, np.nan, (new - old) / old * 100)


def _features(bar: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Features of consecutive bars whose first is the series' first, or too old to matter."""
    close, volume = bar["close"], bar["volume"]
    lag = {k: np.r_[np.full(min(k, len(close)), np.nan), close[:-k]] if k < len(close) else np.full(len(close), np.nan) for k in (1, 2, 3)}
    out = {
        "price_range": bar["high"] - bar["low"],
        "body_size": close - bar["open"],
        "upper_shadow": bar["high"] - np.maximum(bar["open"], close),
        "lower_shadow": np.minimum(bar["open"], close) - bar["low"],
        **{f"close_lag{k}": v for k, v in lag.items()},
        **{f"return_{k}": np.where(np.isnan(lag[k]), 0.0, _change(close, lag[k])) for k in (1, 2)},
        **{f"ma{n}": _over(close, n, np.mean) for n in (5, 10, 20)},
        **{f"volatility_{n}": _over(close, n, lambda v: np.std(v, ddof=1) if len(v) > 1 else np.nan) for n in (5, 10)},
        "volume_ma5": _over(volume, 5, np.mean),
    }
    with np.errstate(divide="ignore", invalid="ignore"):
        out["volume_ratio"] = np.where(out["volume_ma5"] > 0, volume / out["volume_ma5"], 1.0)
        for n in (5, 20):
            out[f"price_to_ma{n}"] = np.where(out[f"ma{n}"] > 0, _change(close, out[f"ma{n}"]), 0.0)
        change = out["return_1"]
        gain = out["avg_gain"] = _over(np.where(change > 0, change, 0.0), 14, np.mean)
        loss = out["avg_loss"] = _over(np.where(change < 0, -change, 0.0), 14, np.mean)
        out["rsi"] = np.where(loss > 0, 100 - 100 / (1 + gain / loss), np.where(gain > 0, 100.0, 50.0))
    return out


def features(candles: DataFrame) -> DataFrame:
    """Features of every new bar, from a ring of the bars before it.

    The state of a symbol is its last ``BACK + 1`` bars: what the longest average reaches back
    to, and the bar before the first return of the strength index. Bars are expected in order,
    as final candles come; one that is not newer than those seen is left out. A symbol's bars
    of one batch are sorted in its task. Labels need the next bar and are not part of it.
    """
    schema = "symbol string, open_time bigint, " + ", ".join(f"{c} double" for c in (*_BAR[1:], *FEATURE_COLUMNS))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring = pd.DataFrame(dict(zip(_BAR, state.get, strict=True))) if state.exists else pd.DataFrame(columns=_BAR)
        new = pd.concat(list(batches))[list(_BAR)].drop_duplicates("open_time").sort_values("open_time")
        if len(ring):
            new = new[new["open_time"] > ring["open_time"].iloc[-1]]
        if not len(new):
            return
        rows = pd.concat([ring, new]) if len(ring) else new
        values = {c: rows[c].to_numpy(np.int64 if c == "open_time" else np.float64) for c in _BAR}
        found = {c: v[len(ring) :] for c, v in {**values, **_features(values)}.items()}
        state.update(tuple(v[-(BACK + 1) :].tolist() for v in values.values()))
        yield pd.DataFrame({"symbol": key[0], **found})

    held = ", ".join(f"{c} array<{'bigint' if c == 'open_time' else 'double'}>" for c in _BAR)
    bars_in = candles.select("symbol", *_BAR).where(F.col("symbol").isNotNull() & F.col("open_time").isNotNull())
    return bars_in.groupBy("symbol").applyInPandasWithState(step, schema, held, "append", GroupStateTimeout.NoTimeout)


# --- rows that expire ---


def expiring(
    rows: DataFrame,
    values: dict[str, str],
    made: Column,
    ttl_seconds: int = TTL_SECONDS["latest_prediction"],
    lateness: str = "0 seconds",
    key: str = "symbol",
) -> DataFrame:
    """Changes of a table of latest rows whose rows live for ``ttl_seconds``.

    A newer row of a key replaces the one in the state and sets its timer to ``made`` plus the
    time to live. When the watermark reaches the timer the key comes out once more, with
    ``live`` false, and leaves the state: nothing stored is scanned for what is too old. A row
    that comes when its time is over changes nothing, unless its key holds an older one.
    ``values`` names the columns kept, with their types.
    """
    names = list(values)
    columns = ", ".join(f"{c} {t}" for c, t in values.items())
    schema = f"{key} string, {columns}, made_at bigint, live boolean"

    def changed(name: str, row: tuple, live: bool) -> pd.DataFrame:
        return pd.DataFrame([(name, *row, live)], columns=[key, *names, "made_at", "live"])

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield changed(group[0], held, False)
            return
        best = held
        for batch in batches:
            plain = batch.astype(object).where(batch.notna(), None)
            for row in plain[[*names, "made_at"]].itertuples(index=False, name=None):
                if best is None or row[-1] > best[-1]:
                    best = row
        if best == held:
            return
        ends = int(best[-1]) + ttl_seconds * 1000
        if ends < state.getCurrentWatermarkMs():
            if held is not None:
                state.remove()
                yield changed(group[0], best, False)
            return
        state.update(best)
        state.setTimeoutTimestamp(ends)
        yield changed(group[0], best, True)

    timed = rows.select(key, *names, made.cast("bigint").alias("made_at"), candle.event_ts(made).alias("event_ts"))
    timed = timed.where(F.col(key).isNotNull() & F.col("made_at").isNotNull()).withWatermark("event_ts", lateness)
    return timed.groupBy(key).applyInPandasWithState(step, schema, f"{columns}, made_at bigint", "update", GroupStateTimeout.EventTimeTimeout)


def expiring_table(path: str, values: dict[str, str], key: str = "symbol") -> KeyedTable:
    """Latest rows of all keys that ever had one, with ``live`` telling the current ones."""
    columns = ", ".join(f"{c} {t}" for c, t in values.items())
    fields = T.StructType.fromDDL(f"{key} string, {columns}, made_at bigint, live boolean, turn bigint, shard int")
    return KeyedTable(path, fields, [key], ["shard"], ["turn"])


def start_expiring(
    rows: DataFrame,
    values: dict[str, str],
    made: Column,
    table: KeyedTable,
    checkpoint: str,
    ttl_seconds: int = TTL_SECONDS["latest_prediction"],
    every: str | None = TRIGGER["klines"],
    lateness: str = "0 seconds",
) -> StreamingQuery:
    """Keep a hot table whose rows expire by themselves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Of one key a batch holds one change at most, so its number orders the changes.
        shard = F.pmod(F.hash("symbol"), F.lit(16))
        table.upsert(batch.withColumns({"turn": F.lit(batch_id).cast("bigint"), "shard": shard}))

    return run(expiring(rows, values, made, ttl_seconds, lateness), "expiring", "update", write, checkpoint, every)


def hot_rows(table: KeyedTable, spark) -> DataFrame:
    """The rows of a hot table that have not expired."""
    return table.read(spark).where("live").drop("live", "turn", "shard")


# --- summaries of every minute ---


def quantile_partials(events: DataFrame, time: str, value: str, lateness: str = LATENESS["trades"]) -> DataFrame:
    """The sketch of every minute as a stream; ``operators.partials`` folds it into windows."""
    known = events.where(F.col(value).isNotNull() & ~F.isnan(value))
    timed = known.withColumns({"event_ts": candle.event_ts(F.col(time)), **bucketed(F.col(value))}).withWatermark("event_ts", lateness)
    counted = timed.groupBy(F.window("event_ts", "1 minute"), "side", "bucket").agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.unix_millis("window.start").alias("minute"), "side", "bucket", "events")


def start_quantile_partials(
    events: DataFrame, time: str, value: str, table: KeyedTable, checkpoint: str, every: str | None = TRIGGER["klines"], lateness: str = LATENESS["trades"]
) -> StreamingQuery:
    """Keep the stored sketches of all minutes; a count that grows replaces the one before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.withColumn("date", day_of(F.col("minute"))))

    return run(quantile_partials(events, time, value, lateness), "quantile_partials", "update", write, checkpoint, every)
