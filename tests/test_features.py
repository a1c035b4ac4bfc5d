import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tapewright.operators import features as op
from tapewright.operators.blocks import BLOCK, block_window, drop_borrowed, with_borders


def test_monotone_rise_has_full_strength(bars):
    last = op.latest_row(op.features(bars({"A": range(1, 16)}))).collect()[0]
    assert last.rsi == 100.0 and last.return_1 == pytest.approx(100 / 14)


def test_flat_price(bars):
    rows = op.features(bars({"A": [5] * 6})).collect()
    assert {(r.rsi, r.return_1, r.price_to_ma5, r.price_to_ma20) for r in rows} == {(50.0, 0.0, 0.0, 0.0)}


def test_one_row_symbol_has_no_volatility_and_is_cleaned(bars):
    df = op.features(bars({"A": [5]}))
    row = df.collect()[0]
    assert row.volatility_5 is None and row.target is None
    assert op.clean(df, None).count() == 0


def test_clean_loses_first_and_last_row_per_symbol(bars):
    df = op.features(bars({"A": range(1, 11), "B": range(1, 4)}))
    assert rows_of(op.clean(df).groupBy("symbol").count(), "symbol", "count") == [("A", 8), ("B", 1)]


def test_no_volume_and_zero_price(bars):
    rows = op.features(bars({"A": [0, 0, 5, 0]}, volume=0.0)).orderBy("open_time").collect()
    assert [r.volume_ratio for r in rows] == [1.0] * 4
    assert [r.return_1 for r in rows] == [0.0, None, None, -100.0]
    assert rows[0].target is None and rows[2].target == -100.0


def _expected(closes):
    """The features of one series by pandas."""
    c = pd.Series(closes, dtype=float)
    change = (c.diff() / c.shift(1) * 100).fillna(0.0)
    gain, loss = change.clip(lower=0).rolling(14, 1).mean(), (-change.clip(upper=0)).rolling(14, 1).mean()
    rsi = np.where(loss > 0, 100 - 100 / (1 + gain / loss.replace(0, np.nan)), np.where(gain > 0, 100.0, 50.0))
    return pd.DataFrame(
        {
            "return_1": change,
            "ma20": c.rolling(20, 1).mean(),
            "volatility_10": c.rolling(10, 2).std(),
            "rsi": rsi,
            "target": (c.shift(-1) - c) / c * 100,
        }
    )


@pytest.mark.parametrize("block_bars", [None, 1, 3, 7, 64, 4096])
def test_blocks_do_not_change_any_feature(bars, spark, block_bars):
    rng = np.random.default_rng(3)
    closes = rng.integers(50, 150, 200)
    kept = bars({"HOT": closes, "COLD": closes[:9]}).where("symbol = 'COLD' OR open_time % 2100000 <> 300000 AND (open_time < 9000000 OR open_time > 30000000)")
    got = op.features(kept, "5m", block_bars).orderBy("symbol", "open_time").toPandas()
    assert len(got) == kept.count()
    for symbol, part in got.groupby("symbol"):
        want = _expected(part["close"].to_numpy())
        for column in want:
            np.testing.assert_allclose(
                part[column].astype(float).to_numpy(), want[column].to_numpy(), rtol=1e-9, atol=1e-9, err_msg=f"{symbol} {column}"
            )


def test_borrowed_rows_cross_several_sparse_blocks(spark):
    df = spark.createDataFrame([("A", t) for t in (0, 100, 205, 210, 900)], "k STRING, t BIGINT")
    bordered = with_borders(df, ["k"], ["t"], F.expr("t div 100"), back=3, ahead=1)
    got = rows_of(bordered.where("NOT _own"), BLOCK, "t")
    assert got == [(0, 100), (1, 0), (1, 205), (2, 0), (2, 100), (2, 900), (9, 100), (9, 205), (9, 210)]
    back = bordered.withColumn("before", F.lag("t", 3).over(block_window(["k"], ["t"])))
    assert rows_of(drop_borrowed(back), "t", "before") == [(0, None), (100, None), (205, None), (210, 0), (900, 100)]


def test_latest_k(bars):
    df = op.latest_k(bars({"A": range(10), "B": range(2)}), 3)
    assert rows_of(df, "symbol", "close") == [("A", 7.0), ("A", 8.0), ("A", 9.0), ("B", 0.0), ("B", 1.0)]
