"""Merkle manifest of a corpus: a tree of digests by source, and a proof for every document.

The documents of a source, in order of their ids, are the leaves of a tree in which a parent
is the digest of up to ``FAN`` children; the roots of the sources are the leaves of one more
such tree. A tree is cut into aligned blocks of at most ``FAN ** BLOCK_EDGES`` leaves. A block
is one stored row whose nodes lie in van Emde Boas order: a tree of some levels is the tree
of its upper half, followed by the trees of its lower half, each laid out by the same rule.
``address`` gives the place of a node by arithmetic alone; it serves the construction of a
block as well as the retrieval of siblings. The roots of a source's blocks are the leaves of
its next, ``FAN ** BLOCK_EDGES`` times smaller round, and so on up to one block. Proofs go
the same way down: every block learns the siblings above its root from the block over it.

Texts are read once and leave the first stage as digests. No task holds more than one block
of a tree: ranks come from a range partitioning of all leaves (``positions``), whose last key
is the place of a row in its file, so neither a source nor an id that holds a third of all
rows meets in one task.

Defined results: NULL is encoded as ``-``, apart from an empty text (``0:``); NULL ids come
before others, and a NULL id is never tampered with; rows that repeat an id are leaves of
their own, ordered by leaf, so that equal rows share a leaf but not a proof; a NULL source is a
source of its own, before all others, and not the empty one; extra columns are left out; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.positions import numbered, with_place
from tapewright.operators.joins import broadcast_if_small
from tapewright.session import materialize

FAN_BITS = 4
FAN = 1 << FAN_BITS
#: Levels of edges of a stored block.
BLOCK_EDGES = 3
BLOCK = FAN**BLOCK_EDGES
WIDTH = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPERED_ONE_IN = 5

#: Most bytes of trees or proofs handed back to Spark at once.
BATCH_BYTES = 4 << 20


# --- one block, in a task ---


def nodes_in(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` of a depth (root 0) in a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(depth, index, upper)
    below = FAN_BITS * (depth - upper)
    tree = index >> below
    inside = address(depth - upper, index - (tree << below), levels - upper)
    return nodes_in(upper) + tree * nodes_in(levels - upper) + inside


@lru_cache(maxsize=32)
def _places(depth: int, levels: int) -> list[int]:
    """Byte offsets of all nodes of a depth."""
    return (address(depth, np.arange(FAN**depth), levels) * WIDTH).tolist()


def edges(total: int) -> int:
    """Levels of edges over ``total`` leaves."""
    return -(-(max(total, 1) - 1).bit_length() // FAN_BITS)


def levels_of(total: int) -> int:
    """Levels of a block of a tree of ``total`` leaves: of all its blocks alike."""
    return 1 + min(BLOCK_EDGES, edges(total))


def parent(children: bytes) -> bytes:
    return hashlib.sha256(children.hex().encode()).digest()


def build(leaves: list[bytes], levels: int) -> bytes:
    """A block in van Emde Boas order, up to its last leaf, which no node lies behind."""
    tree = bytearray(_places(levels - 1, levels)[len(leaves) - 1] + WIDTH)
    nodes = leaves
    for depth in range(levels - 1, -1, -1):
        for place, node in zip(_places(depth, levels), nodes):
            tree[place : place + WIDTH] = node
        nodes = [parent(b"".join(nodes[k : k + FAN])) for k in range(0, len(nodes), FAN)]
    return bytes(tree)


def siblings(tree: bytes, levels: int, leaves: int, index: int) -> Iterator[tuple[bytes, bytes]]:
    """Digests before and after a leaf and its ancestors below the root, upwards."""
    for depth in range(levels - 1, 0, -1):
        places, first = _places(depth, levels), index & -FAN
        last = min(first + FAN, leaves)
        before = b"".join([tree[p : p + WIDTH] for p in places[first:index]])
        yield before, b"".join([tree[p : p + WIDTH] for p in places[index + 1 : last]])
        index, leaves = index >> FAN_BITS, -(-leaves // FAN)


def packed(path: Iterable[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: for each level the numbers of digests before and after, and these."""
    return b"".join(bytes([len(b) // WIDTH, len(a) // WIDTH]) + b + a for b, a in path)


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    path, at = [], 0
    while at < len(data):
        middle = at + 2 + data[at] * WIDTH
        end = middle + data[at + 1] * WIDTH
        path.append((data[at + 2 : middle], data[middle:end]))
        at = end
    return path


def folded(node: bytes, path: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The root over a leaf with the given siblings."""
    for before, after in path:
        node = parent(before + node + after)
    return node


def proof(path: Iterable[tuple[bytes, bytes]]) -> str:
    return hashlib.sha256(b"".join(b + a for b, a in path).hex().encode()).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, sized: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``BATCH_BYTES`` in column ``sized``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sized]) + 100
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_BLOCK = pa.schema([("tree_id", pa.int64()), ("block", pa.int64()), ("total", pa.int64()), ("leaves", pa.int32()), ("tree", pa.binary())])
_PATH = pa.schema([("tree_id", pa.int64()), ("block", pa.int64()), ("path", pa.binary())])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def blocks() -> Iterator[tuple]:
        for (tree_id, block, total), rows in groupby(_rows(batches), key=lambda r: r[:3]):
            leaves = [r[4] for r in rows]
            yield tree_id, block, total, len(leaves), build(leaves, levels_of(total))

    yield from _batches(blocks(), _BLOCK, 4)


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path from every leaf of a block to the root of all."""

    def paths() -> Iterator[tuple]:
        for tree_id, block, total, leaves, tree, above in _rows(batches):
            for k in range(leaves):
                yield tree_id, block * BLOCK + k, packed(siblings(tree, levels_of(total), leaves, k)) + above

    yield from _batches(paths(), _PATH, 2)


_ANSWER = pa.schema([(name, pa.string()) for name in ("doc_id", "leaf", "subroot", "proof_sha256", "folded_root")])


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proofs of the documents of every block; its own row comes before theirs."""

    def answers() -> Iterator[tuple]:
        for _, rows in groupby(_rows(batches), key=lambda r: r[:2]):
            _, _, _, total, leaves, tree, above, subroot, *_ = next(rows)
            levels, shared = levels_of(total), unpacked(above)
            for _, _, slot, _, _, _, _, _, doc_id, leaf, changed in rows:
                path = [*siblings(tree, levels, leaves, slot), *shared]
                yield doc_id, leaf.hex(), subroot.hex(), proof(path), folded(changed or leaf, path).hex()

    yield from _batches(answers(), _ANSWER, 1)


# --- the forest, in Spark ---


def _encoded(column: Column) -> Column:
    """A value with its length; NULL is a dash."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(_encoded(F.col(c)) for c in FIELDS[:-1]), _encoded(text)).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """Id, source and leaf of every document, and the leaf of its tampered copy if there is one."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    changed = _leaf(F.translate(F.col("text").cast("string"), UPPER, LOWER))
    return docs.select(*FIELDS).select("doc_id", F.col("source").cast("string").alias("source"), _leaf(F.col("text")).alias("leaf"), F.when(chosen, changed).alias("changed"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree_id", "block").sortWithinPartitions("tree_id", "block", "slot")


def _in_blocks(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.select("tree_id", F.expr(f"rank div {BLOCK}").alias("block"), "total", (F.col("rank") % BLOCK).cast("int").alias("slot"), *more)


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of all trees over ``nodes`` (tree_id, rank, total, node), round by round, and the
    root of every tree. The number of rounds is the logarithm of the largest tree."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    rounds, roots = [], None
    while True:
        schema = "tree_id bigint, block bigint, total bigint, leaves int, tree binary"
        blocks = materialize(_dealt(_in_blocks(nodes, "node")).mapInArrow(_build, schema), "merkle-blocks")
        rounds.append(blocks)
        top = F.substring("tree", 1, WIDTH)
        done = blocks.where(F.col("total") <= BLOCK).select("tree_id", top.alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if most <= BLOCK:
            return rounds, roots
        total = F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total")
        nodes = blocks.where(F.col("total") > BLOCK).select("tree_id", F.col("block").alias("rank"), total, top.alias("node"))
        most = -(-most // BLOCK)


def with_paths(rounds: list[DataFrame], over: DataFrame) -> DataFrame:
    """The blocks of the first round, each with the path over its root; ``over`` holds the path
    over the root of every tree."""
    above = None
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k]
        known = blocks.where(F.col("total") <= BLOCK).join(over, "tree_id")
        if above is not None:
            known = known.unionByName(blocks.where(F.col("total") > BLOCK).join(above, ["tree_id", "block"]))
        if k:
            above = paths(known)
    return known.select("tree_id", "block", "total", "leaves", "tree", "path")


def paths(blocks: DataFrame) -> DataFrame:
    """The path from every leaf of the given blocks to the root of all."""
    columns = blocks.select("tree_id", "block", "total", "leaves", "tree", "path")
    return materialize(columns.mapInArrow(_descend, "tree_id bigint, block bigint, path binary"), "merkle-paths")


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, root of the source, root of all and digest of the proof of every document, and
    the root that its (for one in five, tampered) leaf folds to with the proof."""
    kind = docs.schema["doc_id"].dataType
    stored = with_place(materialize(leaves(docs), "merkle-leaves"))
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf", "file", "row")]
    ranked = numbered(stored, order, "merkle-order")

    sources = ranked.groupBy("source").agg(F.min("rank").alias("begin"), F.count(F.lit(1)).alias("total"))
    sources = materialize(numbered(sources, [F.col("begin")], "merkle-sources").withColumnRenamed("rank", "tree_id"), "merkle-sources")
    named = broadcast_if_small(sources.select(F.col("source").alias("of"), "begin", "total", "tree_id"))
    nodes = ranked.join(named, F.col("source").eqNullSafe(F.col("of")))
    nodes = nodes.select("tree_id", (F.col("rank") - F.col("begin")).alias("rank"), "total", F.col("leaf").alias("node"), "doc_id", "changed")
    rounds, subroots = grow(nodes)

    forest = subroots.select(F.lit(0).cast("bigint").alias("tree_id"), F.col("tree_id").alias("rank"), F.lit(sources.count()).cast("bigint").alias("total"), F.col("root").alias("node"))
    top, root = grow(forest)
    bare = root.select("tree_id", F.lit(b"").alias("path"))
    over = paths(with_paths(top, bare)).select(F.col("block").alias("tree_id"), "path")

    # The row of a block comes before those of its documents.
    heads = with_paths(rounds, over).join(subroots, "tree_id")
    columns = {"total": "bigint", "leaves": "int", "tree": "binary", "path": "binary", "root": "binary"}, {"doc_id": "string", "leaf": "binary", "changed": "binary"}
    own, of_rows = ([F.lit(None).cast(t).alias(c) for c, t in part.items()] for part in columns)
    heads = heads.select("tree_id", "block", F.lit(-1).alias("slot"), *columns[0], *of_rows)
    members = _in_blocks(nodes, F.col("doc_id").cast("string").alias("doc_id"), F.col("node").alias("leaf"), "changed").drop("total")
    members = members.select("tree_id", "block", "slot", *own, *columns[1])
    schema = "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string"
    proved = _dealt(heads.unionByName(members)).mapInArrow(_prove, schema)

    whole = root.first()  # one digest
    proved = proved.withColumns({"doc_id": F.col("doc_id").cast(kind), "root": F.lit(whole["root"].hex() if whole else None).cast("string")})
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified)
