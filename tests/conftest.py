"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapewright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TRADE_COLUMNS = "symbol STRING, trade_id BIGINT, price DOUBLE, quantity DOUBLE, trade_time BIGINT, is_buyer_maker BOOLEAN"
BAR_COLUMNS = (
    "symbol STRING, open_time BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
)


@pytest.fixture
def trades(spark):
    """Trades from (symbol, id, price, quantity, time, seller is maker) tuples."""
    return lambda rows: spark.createDataFrame(rows, TRADE_COLUMNS)


@pytest.fixture
def bars(spark):
    """Five-minute candles from closes, one series per symbol."""

    def make(series, volume=1.0, step=300_000):
        rows = [
            (symbol, k * step, float(c), float(c), float(c), float(c), float(volume))
            for symbol, closes in series.items()
            for k, c in enumerate(closes)
        ]
        return spark.createDataFrame(rows, BAR_COLUMNS)

    return make


def rows_of(df, *columns):
    """Sorted tuples of the given columns."""
    return sorted(tuple(r) for r in df.select(*columns).collect())
