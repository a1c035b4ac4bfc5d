"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.session import materialize

ROUNDS = 60
ROWS_PER_TASK = 100_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected with (``root``), for all ends of ``links``
    (columns ``a``, ``b``; directions, repeats and loops do not matter).

    Large stars hang every greater neighbour of a node on the least one, small stars do so
    with the lesser ones; both keep what is connected and end in stars. Each is one
    aggregation, which adds up before it shuffles, and one join, whose aggregated side has
    every node once. Rounds are written to the shared folder, so lineage stays short.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialize(links.distinct(), "links")
    seen, size = None, links.count()
    for _ in range(ROUNDS):
        # As many tasks as the links are worth, however many partitions a shuffle has.
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, size // ROWS_PER_TASK)
        links = materialize(small_star(large_star(links), tasks).coalesce(tasks), "links")
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, size = mark, mark[0]
    else:
        raise RuntimeError("links did not settle")
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    greater = both.filter("b > a").join(least, "a")
    return greater.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def small_star(links: DataFrame, tasks: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).coalesce(tasks)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
