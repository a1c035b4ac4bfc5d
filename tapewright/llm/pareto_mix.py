"""Mixing sources to target weights by Pareto order sampling.

Sources get shares of all words by weight, but no more than ``MOST`` times what they hold;
what a full source leaves goes to the others by weight. A source whose target is f times its
words takes every document floor(f) times for certain and samples the rest of its target:
each document has inclusion odds that grow with its size, is ranked by random odds u / (1 - u)
divided by its inclusion odds, and the sample is the start of that order. Its size is fixed
in words: it goes on as long as whole documents fit into the rest. Where more than
``TOLERANCE`` of a target is then open, the order is gone on with, over the documents that
still fit, up to ``ROUNDS`` times; this concerns small sources with long documents. At last the
one document that comes nearest to what remains is added if that brings the sum nearer. The
common factor of a source's odds does not change its order and is left out.

The random number comes from the id and the text, so reruns agree; a place in a file only
parts rows that are alike. Sizes are counted once; the order is a range partitioning of
narrow rows (``positions``), and running sums are taken within its parts, after the sums of
the parts before: no source, however large, meets in one task. All expressions are built-in.

Defined results: a NULL or empty text has size 0 and is never taken; a NULL source is one of
its own, after all others; NULL ids and rows that repeat an id are documents of their own,
equal rows with one random number between them; a table without words has targets of 0; extra
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.positions import in_order, numbered, with_place
from tapewright.operators.joins import broadcast_if_small
from tapewright.session import materialize

#: Weights of the sources in their order, repeated.
WEIGHTS = (1, 2, 3)
#: Most times a source, and so a document, is taken.
MOST = 3

WORDS = r"[^\x20\x09-\x0D]++"
#: Share of a target that may stay open, and how often the order is gone on with otherwise.
TOLERANCE, ROUNDS = 0.002, 4
#: Hexadecimal digits that make a random number, and what they reach.
_DIGITS, _RANGE = 13, float(1 << 52)


def sizes(docs: DataFrame) -> DataFrame:
    """Id, source, words and the ``draw`` (a digest of id and text) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seed = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(text.cast("binary")))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
        F.md5(seed.cast("binary")).alias("draw"),
    )


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with their ``target`` in words.

    Every pass gives the words that full sources leave to the others by weight, until no
    source is newly full; it sums over the sources and brings back three numbers.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    order = [F.col("source").asc_nulls_last()]
    rows = materialize(numbered(sources, order, "mix-order").withColumn("weight", weight), "mix-sources")
    most = F.col("source_size") * MOST
    words, weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    rate, full = (words or 0) / (weights or 1), 0
    while True:
        over = most < F.lit(rate) * F.col("weight")
        held, left, count = rows.agg(F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if not left or count == full:
            break
        rate, full = (words - (held or 0)) / left, count
    target = F.least(most.cast("double"), F.lit(rate) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _running(rows: DataFrame) -> DataFrame:
    """Rows with the words ``before`` each of them in the order of its source."""
    order = [F.col("source").asc_nulls_last(), F.col("key").asc_nulls_last(), *map(F.col, ("draw", "file", "row"))]
    ranked = in_order(rows, order, "mix-order")
    spans = ranked.groupBy(F.col("source").alias("of"), F.col("part").alias("in_part")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("of").orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = materialize(spans.select("of", "in_part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("earlier")), "mix-spans")
    within = Window.partitionBy("source", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("in_part_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part"))
    placed = ranked.join(broadcast_if_small(spans), same)
    return placed.withColumn("before", F.col("earlier") + F.col("in_part_before")).select(*rows.columns, "before")


def _of_source(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Rows with the columns that ``side`` has for their source."""
    return rows.join(broadcast_if_small(side.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _gaps(rows: DataFrame) -> DataFrame:
    """Words of each source that its sample leaves open."""
    held = F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0))
    return materialize(rows.groupBy("source").agg((F.max("rest") - held).alias("gap"), F.max("target").alias("goal")), "mix-gaps")


def mixed(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken of it."""
    stored = with_place(materialize(sizes(docs), "mix-sizes"))
    goals = targets(stored.groupBy("source").agg(F.sum("size").alias("source_size")))
    u = (F.conv(F.substring("draw", 1, _DIGITS), 16, 10).cast("double") + 0.5) / _RANGE
    rows = _of_source(stored, goals).withColumn("key", F.when(F.col("size") > 0, u / (1 - u) / F.col("size")))
    copies = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rows = rows.withColumn("copies", copies).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))

    rows = _running(rows)
    rows = materialize(rows.withColumn("fits", (F.col("size") > 0) & (F.col("before") + F.col("size") <= F.col("rest"))).drop("before"), "mix-fitting")
    gaps = _gaps(rows)
    for _ in range(ROUNDS):
        wide = gaps.where(F.col("gap") > TOLERANCE * F.col("goal"))
        if wide.isEmpty():
            break
        left = _of_source(rows.where(~F.col("fits") & (F.col("size") > 0)), wide).where(F.col("size") <= F.col("gap"))
        more = _running(left).where(F.col("before") + F.col("size") <= F.col("gap"))
        more = broadcast_if_small(materialize(more.select("file", "row", F.lit(True).alias("more")), "mix-more"))
        rows = rows.join(more, ["file", "row"], "left").withColumn("fits", F.col("fits") | F.coalesce("more", F.lit(False))).drop("more")
        rows = materialize(rows, "mix-fitting")
        gaps = _gaps(rows)

    rows = rows.join(_completing(rows, gaps), ["file", "row"], "left")
    taken = F.col("size") * (F.col("copies") + F.col("fits").cast("long") + F.coalesce("completes", F.lit(0)))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _completing(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """Place of the document of each source that comes nearest to what its sample leaves open;
    none where all of them are farther from it than nothing."""
    near = (F.col("size") > 0) & ~F.col("fits") & (F.col("size") < 2 * F.col("gap"))
    left = _of_source(rows, gaps.select("source", "gap")).where(near)
    best = left.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("far"), "draw", "file", "row")).alias("best"))
    return broadcast_if_small(best.select("best.file", "best.row", F.lit(1).alias("completes")))


def _round_sql(k: int) -> str:
    """One more walk down the order, over documents that still fit."""
    return f"""open_{k} AS (
  SELECT *, size > 0 AND NOT fits AND size <= gap AND gap > {TOLERANCE} * target AS near FROM (
    SELECT *, rest - CAST(sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS BIGINT) AS gap FROM fitted_{k})),
fitted_{k + 1} AS (
  SELECT * EXCLUDE (gap, near) REPLACE (fits OR (near AND sum(size) OVER (PARTITION BY source, near ORDER BY key NULLS LAST, draw
    ROWS UNBOUNDED PRECEDING) <= gap) AS fits) FROM open_{k}),
"""


SQL = rf"""WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS draw FROM documents),
sources AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
filled AS (
  SELECT 0 AS step, CAST(sum(source_size) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS rate, CAST(-1 AS BIGINT) AS full_before, CAST(0 AS BIGINT) AS full_now FROM sources
  UNION ALL
  SELECT step + 1, CASE WHEN n_full = full_now THEN rate ELSE next_rate END, full_now, n_full FROM (
    SELECT step, rate, full_now,
      (SELECT count(*) FROM sources WHERE {MOST} * source_size < rate * weight) AS n_full,
      CAST((SELECT sum(source_size) FROM sources) - coalesce((SELECT sum({MOST} * source_size) FROM sources WHERE {MOST} * source_size < rate * weight), 0) AS DOUBLE)
        / CAST((SELECT sum(weight) FROM sources WHERE {MOST} * source_size >= rate * weight) AS DOUBLE) AS next_rate
    FROM filled WHERE full_before <> full_now)),
goals AS (
  SELECT source, source_size, least(CAST({MOST} * source_size AS DOUBLE), (SELECT rate FROM filled ORDER BY step DESC LIMIT 1) * weight) AS target FROM sources),
drawn AS (
  SELECT *, (CAST(CAST('0x' || substr(draw, 1, {_DIGITS}) AS BIGINT) AS DOUBLE) + 0.5) / {_RANGE!r} AS u FROM sized),
keyed AS (
  SELECT doc_id, draw, size, d.source, source_size, target, CASE WHEN size > 0 THEN u / (1 - u) / size END AS key,
    coalesce(floor(target / nullif(source_size, 0)), 0) AS copies,
    target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size AS rest
  FROM drawn d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source),
fitted_0 AS (
  SELECT *, size > 0 AND sum(size) OVER (PARTITION BY source ORDER BY key NULLS LAST, draw ROWS UNBOUNDED PRECEDING) <= rest AS fits FROM keyed),
{"".join(map(_round_sql, range(ROUNDS)))}completed AS (
  SELECT *, CASE WHEN near THEN row_number() OVER (PARTITION BY source, near ORDER BY abs(size - gap), draw) END AS place
  FROM (SELECT *, size > 0 AND NOT fits AND size < 2 * gap AS near FROM (
    SELECT *, rest - CAST(sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS BIGINT) AS gap FROM fitted_{ROUNDS})))
SELECT doc_id, size, source_size, target,
  CAST(size * (copies + CASE WHEN fits THEN 1 ELSE 0 END + CASE WHEN place = 1 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM completed"""
