"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.suite.inputs import Inputs
from tapewright.suite.sql import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NUDGE = 1e-9


def query(name: str, sql: str | None = None, rounded: str = "", places: int = 6):
    """Register ``build(inputs) -> DataFrame`` under ``name``.

    The columns named in ``rounded`` hold floating-point results whose last digits
    depend on the order of addition; both sides round them. ``NUDGE`` moves results that
    lie exactly between two rounded values off that edge, and keeps zero unsigned.
    """
    columns = rounded.split()

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(Inputs(spark, folder))
            return df.withColumns({c: F.round(F.col(c) + NUDGE, places) + F.lit(0.0) for c in columns}) if columns else df

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            body = sql
            if columns:
                replaced = ", ".join(f"round({c} + {NUDGE!r}, {places}) + 0.0 AS {c}" for c in columns)
                body = f"SELECT * REPLACE ({replaced}) FROM ({sql})"
            ORACLES[name] = with_ctes(body)
        return build

    return register
