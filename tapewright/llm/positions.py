"""Global order of a table without a task that holds it: numbers of rows, and their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.session import materialize

#: Bits of a running number within its part.
_PART_BITS = 33


def with_place(stored: DataFrame) -> DataFrame:
    """A written table with the place of every row (``file``, ``row``): a last key that splits
    equal rows between parts and is the same whenever the table is read."""
    return stored.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` written in the order ``order``, dealt by ranges of it into ``part``s.

    ``at`` ascends in that order, by one within a part.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    return stored.withColumn("part", F.shiftright("at", _PART_BITS))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their ``rank`` in the order ``order``, from 0.

    Only one row for each part is broadcast, and a shuffle has a bounded number of parts.
    """
    stored = in_order(rows, order, name)
    parts = stored.groupBy("part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("rows_in_part"))
    before = F.sum("rows_in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", (F.coalesce(before, F.lit(0)) - F.col("first_at")).alias("shift"))
    return stored.join(F.broadcast(parts), "part").withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")
