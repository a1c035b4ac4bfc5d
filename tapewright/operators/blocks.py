"""Row-based window functions over a long or hot key, without one task per key.

``Window.partitionBy("symbol")`` sends a symbol's whole history to one task. Here the
history is cut into time blocks, and each block gets copies of the few rows its frames
reach into: the last ``back`` rows before it and the first ``ahead`` rows after it,
counted in rows, however many blocks away they lie. Window functions partitioned by
key and block then give the same answer as over the whole key.

Cost: one shuffle of the rows by (key, block), used both to hand a block its own rows and
to find the rows near its ends. What is then handled per key is at most ``back + ahead``
rows per block, so it grows with the number of blocks and not with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK, OWN = "_block", "_own"

#: Block length for raw ticks. A symbol with 30 TB of trades a year has some 300 MB in five
#: minutes, which one task sorts; a quiet symbol borrows about one row per row.
BLOCK_MS = 300_000


def with_borders(
    df: DataFrame, keys: list[str], order: list[str], block: Column, back: int = 0, ahead: int = 0
) -> DataFrame:
    """``df`` plus borrowed rows; ``_block`` names the block a row serves, ``_own`` is
    false for borrowed rows. ``block`` must not decrease along ``order``."""
    own = df.withColumn(BLOCK, block).repartition(*keys, BLOCK)
    near = _near_ends(own, block_window(keys, order), back, ahead)
    along = Window.partitionBy(*keys).orderBy(*order)
    nothing = F.array().cast("array<bigint>")
    # A row near its block's end serves the blocks that start within ``back`` rows after
    # it, one near the start those that end within ``ahead`` rows before it. Every block
    # between has all its rows among the near ones or too many rows to look through.
    later = F.collect_list(BLOCK).over(along.rowsBetween(1, back)) if back else nothing
    earlier = F.collect_list(BLOCK).over(along.rowsBetween(-ahead, -1)) if ahead else nothing
    reached = near.withColumns({"_later": later, "_earlier": earlier})
    served = F.array_union(
        F.when(F.col("_last"), F.col("_later")).otherwise(nothing),
        F.when(F.col("_first"), F.col("_earlier")).otherwise(nothing),
    )
    borrowed = (
        reached.withColumn("_to", F.explode(F.array_remove(served, F.col(BLOCK))))
        .select(*df.columns, F.col("_to").alias(BLOCK))
        .repartition(*keys, BLOCK)
    )
    return own.withColumn(OWN, F.lit(True)).unionByName(borrowed.withColumn(OWN, F.lit(False)))


def _near_ends(own: DataFrame, within: WindowSpec, back: int, ahead: int) -> DataFrame:
    """The last ``back`` and the first ``ahead`` rows of every block, marked as such."""
    never = F.lit(False)
    marked = own.withColumns(
        {
            "_last": F.lead(F.lit(1), back).over(within).isNull() if back else never,
            "_first": F.lag(F.lit(1), ahead).over(within).isNull() if ahead else never,
        }
    )
    return marked.where(F.col("_last") | F.col("_first"))


def block_window(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def drop_borrowed(df: DataFrame) -> DataFrame:
    return df.where(F.col(OWN)).drop(BLOCK, OWN)
