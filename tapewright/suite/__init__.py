"""Registered queries over the given tables, each with an equivalent SQL text."""

from tapewright.suite import (  # noqa: F401
    book_queries,
    candle_queries,
    decode_queries,
    feature_queries,
    market_queries,
    model_queries,
    partial_queries,
    serving_queries,
    state_queries,
    stream_queries,
)
from tapewright.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
