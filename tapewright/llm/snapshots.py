"""Collapse of logged conversation snapshots, and their rendering as training text.

A chat service logs a conversation again after every turn, so most logs are prefixes of
longer ones. Every turn prefix of a conversation gets a rolling hash: the hash of a prefix
combines the hash of the prefix before it with the next turn. A conversation whose last
hash is among the inner prefix hashes of any conversation is a snapshot; an anti-join
leaves the maximal ones, and of equal ones that with the smallest id. They are rendered
with a role header before every turn.

Hashes are 256 bits of role and text, so equal hashes are taken for equal turns. Exact
repeats of a turn are dropped before and after a shuffle by conversation and turn, and only
then is a conversation put together, so it is bounded by its different turns; equal prefixes,
however many conversations share them, are combined before the shuffle.

Defined results: turns are ordered by number (NULL first), then role and text; exact
repeats of a row count once; a NULL role or text counts as empty; rows with a NULL
conversation id belong to none and are left out; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before and after each turn.
HEADER, FOOTER = "<|im_start|>", "<|im_end|>"
#: Turns hashed in one go.
BLOCK = 256


def conversations(rows: DataFrame) -> DataFrame:
    """One row for each conversation with its turns in order."""
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    return turns.distinct().groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def prefixes(turns: Column) -> Column:
    """Rolling hash of every prefix, from the first turn to the whole conversation.

    In blocks: appending to one long array copies it every time. A block begins with the
    hash that the block before it has ended with.
    """

    def rolled(hashes: Column, t: Column) -> Column:
        own = F.sha2(F.concat_ws("\0", t["role"], t["text"]).cast("binary"), 256)
        return F.array_append(hashes, F.sha2(F.concat(F.element_at(hashes, -1), own).cast("binary"), 256))

    def block(blocks: Column, first: Column) -> Column:
        last = F.element_at(F.element_at(blocks, -1), -1)
        return F.array_append(blocks, F.aggregate(F.slice(turns, first + 1, F.lit(BLOCK)), F.array(last), rolled))

    starts = F.sequence(F.lit(0), F.size(turns) - 1, F.lit(BLOCK))
    blocks = F.aggregate(starts, F.array(F.array(F.lit(""))), block)
    return F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), lambda b: F.slice(b, F.lit(2), F.size(b))))


def maximal(hashed: DataFrame) -> DataFrame:
    """Ids and last hashes of the conversations that no other continues. ``hashed``: ``conv_id``,
    ``prefixes``; the smallest id stands for equal conversations."""
    whole = hashed.select("conv_id", F.element_at("prefixes", -1).alias("hash"))
    distinct = whole.groupBy("hash").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = hashed.select(F.explode(F.slice("prefixes", F.lit(1), F.size("prefixes") - 1)).alias("hash")).distinct()
    return distinct.join(inner, "hash", "left_anti")


def rendered(turns: Column) -> Column:
    """Every turn as header, role, line feed, text and footer."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(HEADER), t["role"], F.lit("\n"), t["text"], F.lit(FOOTER), F.lit("\n"))), ""
    )


def collapse(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_equal`` (conversations equal to it, itself included) and
    ``rendered`` of every maximal conversation."""
    convs = conversations(rows)
    kept = maximal(convs.select("conv_id", prefixes(F.col("turns")).alias("prefixes")))
    return convs.join(kept, "conv_id").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), "n_equal", rendered(F.col("turns")).alias("rendered")
    )


SQL = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS n_turns,
         list(length(role) || ':' || role || length(text) || ':' || text ORDER BY turn NULLS FIRST, role, text) AS turns,
         string_agg('{HEADER}' || role || chr(10) || text || '{FOOTER}' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered
  FROM turns GROUP BY conv_id),
firsts AS (
  SELECT DISTINCT md5(array_to_string(turns[1:k], '|')) AS prefix
  FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM convs)),
equal AS (
  SELECT md5(array_to_string(turns, '|')) AS whole, min(conv_id) AS conv_id, count(*) AS n_equal FROM convs GROUP BY 1)
SELECT c.conv_id, c.n_turns, e.n_equal, c.rendered
FROM convs c JOIN equal e ON c.conv_id = e.conv_id
WHERE e.whole NOT IN (SELECT prefix FROM firsts)
"""
