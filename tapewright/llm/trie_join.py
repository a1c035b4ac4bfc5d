"""Jaccard join of word n-gram sets with prefix trees.

All sets are ordered alike: n-grams that many documents hold come last, the others in the
order of their hash. Two sets that are similar enough share an n-gram among the first few
of either. The join goes from coarse to exact:

1. Equal sets are joined into one class by size and two sums of hashes.
2. Classes that share a prefix n-gram are candidates if sizes, positions and the distance
   of two bit sketches allow the similarity; all three are bounds, so nothing is lost. A
   prefix n-gram with more than ``CROWD`` classes makes all of them candidates, without pairs.
   Connected candidates form a cluster; no link can cross clusters.
3. Each set travels once to its cluster, where a trie holds the ordered sets. A set
   traverses the trie: sets with equal beginnings share the partial overlap, subtrees are
   left as soon as the remaining lengths cannot make up for what is missing, and subtrees
   already connected with the set are skipped. What is left is counted exactly.
4. Clusters of more than ``GROUP`` sets are cut into blocks, twice and differently, and
   components formed; only where a cluster still falls apart do the sets outside its largest
   component visit all blocks.

Links therefore span each component, without all pairs of a group of copies. Hashes of
n-grams have 64 bits; overlaps count hashes.

Defined results: NULL or empty texts have no n-grams and are linked with nothing; a text
with fewer words than n has its whole word sequence as one n-gram; rows that repeat an id
belong together, and with them the classes of their sets; rows with a NULL id are linked with nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import pieces, shuffle_partitions, texts
from tapewright.llm.components import components
from tapewright.llm.words import Words, mix, sequence
from tapewright.session import materialize

#: N-grams known to be frequent: at most so many, each with at least this count.
MAX_FREQUENT, MIN_FREQUENT = 1 << 18, 16
#: N-grams that a task counts before it drops those it met once.
COUNTED = 4_000_000
SKETCH_WORDS = 8
#: Bits of the sieve of prefix n-grams that occur twice.
SIEVE_BITS = 1 << 26
CROWD = 4096
GROUP = 512
#: Ids of clustered sets that may be broadcast instead of shuffling the texts to them.
BROADCAST_IDS = 2_000_000
#: What tells classes apart: size of the set and two sums of its hashes.
KEYS = ("n", "s1", "s2")
#: Tokens of a trie edge that are compared before the bound is looked at again.
STRIDE = 96


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` between sets of ``n``-word sequences."""

    n: int
    percent: int

    def needed(self, a: np.ndarray | int, b: np.ndarray | int):
        """Least overlap of sets of these sizes that is similar enough."""
        return -((-self.percent * (a + b)) // (100 + self.percent))

    def prefix(self, size: int) -> int:
        return size - -((-self.percent * size) // 100) + 1


@dataclass(frozen=True)
class Order:
    """The global order: level of frequent n-grams (all others 0), then hash."""

    frequent: np.ndarray
    level: np.ndarray

    def arranged(self, grams: np.ndarray) -> np.ndarray:
        """Ascending ``grams`` in global order."""
        if not len(self.frequent) or not len(grams):
            return grams
        at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
        level = np.where(self.frequent[at] == grams, self.level[at], 0)
        return grams[np.argsort(level, kind="stable")]


def gram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The ascending distinct n-gram hashes of each text."""
    words = Words(column)
    values, at = words.grams(n)
    border = np.searchsorted(at, words.first)
    out = []
    for k in range(len(column)):
        own = words.first[k + 1] - words.first[k]
        if 0 < own < n:
            out.append(np.array([sequence(words.hash[words.first[k] : words.first[k + 1]])], np.uint64))
        else:
            out.append(np.unique(values[border[k] : border[k + 1]]))
    return out


#: Bytes of a prefix n-gram's hash that travel; equal rests only add candidates.
GRAM_BYTES = 5


def packed(grams: np.ndarray) -> bytes:
    """The low ``GRAM_BYTES`` bytes of each hash."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // GRAM_BYTES, 8), np.uint8)
    wide[:, :GRAM_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, GRAM_BYTES)
    return wide.reshape(-1).view("<i8")


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def frequent(rows: DataFrame, like: Similarity) -> Order:
    """Count n-grams over all documents; a task passes on those that it met more than once.

    An n-gram spread so thinly that tasks meet it once counts as rare, which only makes the
    order worse, never the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held.clear()
            often = counts > 1
            return pa.RecordBatch.from_arrays([signed(values[often]), pa.array(counts[often])], ["gram", "count"])

        for piece in pieces(batches):
            # Copies in one piece are taken once; n-grams beyond every prefix cannot matter.
            for s in {(len(s), int(s.sum())): s for s in gram_sets(piece.column("text"), like.n)}.values():
                held.append(s[: 2 * like.prefix(len(s)) + 2])
            if sum(map(len, held)) >= COUNTED:
                yield flush()
        yield flush()

    counts = rows.mapInArrow(run, "gram long, count long").groupBy("gram").agg(F.sum("count").alias("count"))
    top = counts.filter(F.col("count") >= MIN_FREQUENT).orderBy(F.desc("count"), "gram").limit(MAX_FREQUENT).toArrow()
    values = top.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    level = np.log2(np.maximum(1, top.column("count").to_numpy())).astype(np.int8)
    order = np.argsort(values)
    return Order(values[order], level[order])


def sketch(grams: np.ndarray) -> bytes:
    """Parity of the n-grams that fall on each bit: sets whose sketches differ in k bits differ
    in k n-grams at least. A larger set has more bits, by a power of two."""
    bits = 64 * SKETCH_WORDS
    while bits < len(grams) // 2:
        bits *= 2
    parity = np.bincount((mix(grams) >> np.uint64(32)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(raw: bytes, words: int = SKETCH_WORDS) -> np.ndarray:
    """The sketch of the same set with fewer bits: its halves joined by exclusive or."""
    whole = np.frombuffer(raw, np.uint64)
    while len(whole) > words:
        whole = whole[: len(whole) // 2] ^ whole[len(whole) // 2 :]
    return whole


def apart(a: bytes, b: bytes) -> int:
    """How many n-grams two sets differ in, at least."""
    words = min(len(a), len(b)) // 8
    return int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())


def described(rows: DataFrame, like: Similarity, order: Order) -> DataFrame:
    """Size, class sums, prefix and sketch of every document's set."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = gram_sets(piece.column("text"), like.n)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    signed(np.array([s.sum() for s in sets], np.uint64)),
                    signed(np.array([mix(s).sum() for s in sets], np.uint64)),
                    pa.array([packed(order.arranged(s)[: like.prefix(len(s)) if len(s) else 0]) for s in sets], pa.binary()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "s1", "s2", "prefix", "sketch"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, prefix binary, sketch binary")


def sieve(classes: DataFrame) -> np.ndarray:
    """Bits of prefix n-grams that occur in two classes or more; others may share their bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(b"".join(batch.column("prefix").to_pylist())))], ["gram"])

    twice = classes.select("prefix").mapInArrow(run, "gram long").groupBy("gram").count().filter("count > 1")
    bit = F.col("gram").bitwiseAND(F.lit(SIEVE_BITS - 1))
    place, mask = F.shiftright(bit, 5).alias("place"), F.expr("shiftleft(1L, cast(gram & 31 as int))").alias("mask")
    found = twice.select(place, mask).groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()  # SIEVE_BITS / 32 rows at most
    bits = np.zeros(SIEVE_BITS // 32, np.uint32)
    bits[found.column("place").to_numpy()] = found.column("mask").to_numpy().astype(np.uint32)
    return bits


def shared_grams(classes: DataFrame, bits: np.ndarray, kind: str) -> DataFrame:
    """Prefix n-grams that pass the sieve, with their class, its size and their position."""
    shared = classes.sparkSession.sparkContext.broadcast(bits)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sizes = pc.binary_length(batch.column("prefix")).to_numpy() // GRAM_BYTES
            grams = unpacked(b"".join(batch.column("prefix").to_pylist()))
            row = np.repeat(np.arange(len(sizes)), sizes)
            position = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bit = grams & (SIEVE_BITS - 1)
            keep = (table[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
            at = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams[keep]),
                    batch.column("doc_id").take(at),
                    batch.column("n").take(at),
                    pa.array(position[keep].astype(np.int32)),
                    batch.column("sketch").take(at),
                ],
                ["gram", "doc_id", "n", "position", "sketch"],
            )

    return classes.select("doc_id", "n", "prefix", "sketch").mapInArrow(run, f"gram long, doc_id {kind}, n long, position int, sketch binary")


class Forest:
    """Union-find over places 0 to n - 1."""

    def __init__(self, n: int) -> None:
        self.up, self.trees = list(range(n)), n

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        self.trees -= a != b
        return a != b


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, each run as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        first = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or values[k] != values[first]:
                if held and values[first] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(first, k - first))
                last = values[first]
                first = k
    if held:
        yield pa.Table.from_batches(held)


def candidate_links(size: np.ndarray, position: np.ndarray, sketches: np.ndarray, raw: list[bytes], like: Similarity) -> list[tuple[int, int]]:
    """Links that connect the members of one n-gram which may be similar. Rows ascend by size."""
    forest, out = Forest(len(size)), []
    top = np.searchsorted(size, size * 100 // like.percent, "right")
    for k in range(len(size)):
        others = np.arange(k + 1, top[k])
        if not len(others) or forest.trees == 1:
            continue
        needed = like.needed(size[k], size[others])
        rest = np.minimum(size[k] - position[k], size[others] - position[others])
        others, needed = others[rest >= needed], needed[rest >= needed]
        differ = np.bitwise_count(sketches[others] ^ sketches[k]).sum(1)
        for j in others[differ <= size[k] + size[others] - 2 * needed].tolist():
            if forest.root(k) != forest.root(j) and may_be_similar(size, raw, k, j, like):
                forest.join(k, j)
                out.append((k, j))
    return out


def small_group_links(gram: np.ndarray, size: np.ndarray, position: np.ndarray, sketches: np.ndarray, like: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one n-gram that may be similar, for many n-grams with few members each.
    Rows ascend by n-gram and size; row i is compared with row i + 1, then i + 2, ..."""
    left, right = [], []
    live = np.arange(len(gram))
    for d in range(1, len(gram)):
        live = live[live + d < len(gram)]
        live = live[gram[live] == gram[live + d]]
        live = live[100 * size[live] >= like.percent * size[live + d]]  # greater ones follow
        if not len(live):
            break
        other = live + d
        needed = like.needed(size[live], size[other])
        fits = np.minimum(size[live] - position[live], size[other] - position[other]) >= needed
        k, j, needed = live[fits], other[fits], needed[fits]
        fits = np.bitwise_count(sketches[k] ^ sketches[j]).sum(1) <= size[k] + size[j] - 2 * needed
        left.append(k[fits])
        right.append(j[fits])
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))


#: Rows looked at together, and members from which an n-gram is handled alone.
CHUNK_ROWS, MANY = 200_000, 64


def chunk_links(gram: np.ndarray, code: np.ndarray, size: np.ndarray, position: np.ndarray, raw: list[bytes], like: Similarity) -> list[tuple[int, int]]:
    """Links between rows, as few as connect what may be similar. ``code``: the row's class."""
    sketches = np.frombuffer(b"".join(r if len(r) == 8 * SKETCH_WORDS else folded(r).tobytes() for r in raw), np.uint64).reshape(-1, SKETCH_WORDS)
    border = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    members = np.diff(np.r_[border, len(gram)])
    few = np.flatnonzero(np.repeat(members <= MANY, members))
    a, b = small_group_links(gram[few], size[few], position[few], sketches[few], like)
    pairs = list(zip(few[a].tolist(), few[b].tolist()))
    for at, n in zip(border[members > MANY].tolist(), members[members > MANY].tolist()):
        own = slice(at, at + n)
        pairs += [(at + k, at + j) for k, j in candidate_links(size[own], position[own], sketches[own], raw[own], like)]
    forest = Forest(int(code.max()) + 1 if len(code) else 0)
    return [(k, j) for k, j in pairs if may_be_similar(size, raw, k, j, like) and forest.join(int(code[k]), int(code[j]))]


def may_be_similar(size: np.ndarray, raw: list[bytes], k: int, j: int, like: Similarity) -> bool:
    """Look at all bits of two large sets."""
    if min(len(raw[k]), len(raw[j])) == 8 * SKETCH_WORDS:
        return True
    a, b = int(size[k]), int(size[j])
    return apart(raw[k], raw[j]) <= a + b - 2 * like.needed(a, b)


def candidates(classes: DataFrame, like: Similarity) -> DataFrame:
    """Links (``a``, ``b``) whose components contain every pair that can be similar."""
    kind = classes.schema["doc_id"].dataType
    rows = shared_grams(classes, sieve(classes), kind.simpleString())
    sizes = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("least"))
    crowds = materialize(sizes.filter(F.col("members") > CROWD), "crowds")
    crowds = F.broadcast(crowds) if crowds.count() <= BROADCAST_IDS else crowds
    # Whoever shares a crowded n-gram hangs on its least member.
    stars = rows.select("gram", "doc_id").join(crowds, "gram").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    calm = rows.join(crowds.select("gram"), "gram", "left_anti")
    calm = calm.repartition(shuffle_partitions(classes), "gram").sortWithinPartitions("gram", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(upto: int | None) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            if upto is not None:
                held.extend(table.slice(upto).to_batches())
                table = table.slice(0, upto)
            ids = table.column("doc_id").combine_chunks()
            gram, size, position = (table.column(c).to_numpy() for c in ("gram", "n", "position"))
            links = chunk_links(gram, ids.dictionary_encode().indices.to_numpy(), size, position, table.column("sketch").to_pylist(), like)
            ends = [ids.take(pa.array([e[k] for e in links], pa.int64())) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= CHUNK_ROWS:
                gram = np.concatenate([b.column("gram").to_numpy() for b in held])
                last = int(np.searchsorted(gram, gram[-1]))  # the last n-gram may go on
                if last:
                    yield flush(last)
        if held:
            yield flush(None)

    name = kind.simpleString()
    return calm.mapInArrow(run, f"a {name}, b {name}").unionByName(stars)


class Trie:
    """Ordered sets as paths of n-grams; single paths are kept as arrays."""

    __slots__ = ("edge", "below", "members", "longest", "depth")

    def __init__(self, edge: np.ndarray, depth: int) -> None:
        self.edge, self.depth = edge, depth  # depth: n-grams up to the end of the edge
        self.below: dict[int, Trie] = {}
        self.members: list[int] = []
        self.longest = 0

    def insert(self, member: int, grams: np.ndarray) -> None:
        node, at = self, 0
        while True:
            node.longest = max(node.longest, len(grams))
            if at == len(grams):
                node.members.append(member)
                return
            child = node.below.get(int(grams[at]))
            if child is None:
                child = node.below[int(grams[at])] = Trie(grams[at:], len(grams))
                child.longest, child.members = len(grams), [member]
                return
            rest = grams[at : at + len(child.edge)]
            differ = np.flatnonzero(child.edge[: len(rest)] != rest)
            same = int(differ[0]) if len(differ) else len(rest)
            if same < len(child.edge):
                middle = Trie(child.edge[:same], at + same)
                middle.longest = child.longest
                child.edge = child.edge[same:]
                middle.below[int(child.edge[0])] = child
                node.below[int(middle.edge[0])] = middle
                child = middle
            node, at = child, at + same

    def every(self) -> Iterator[int]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield from node.members
            stack += node.below.values()


class Joiner:
    """A trie of sets, and which of all sets are connected so far."""

    def __init__(self, sets: list[np.ndarray], like: Similarity) -> None:
        self.sets, self.like, self.forest, self.trie = sets, like, Forest(len(sets)), Trie(np.zeros(0, np.uint64), 0)
        self.share = like.percent / (100 + like.percent)

    def insert(self, x: int) -> None:
        self.trie.insert(x, self.sets[x])

    def probe(self, grams: np.ndarray, same) -> Iterator[int]:
        """Members similar to a set that ``same(member)`` does not yet call connected."""
        own, size = np.sort(grams), len(grams)
        stack = [(child, 0) for child in self.trie.below.values()]
        while stack:
            node, overlap = stack.pop()
            if all(map(same, node.every())):
                continue
            at, depth, alive = 0, node.depth - len(node.edge), True
            while at < len(node.edge) and alive:
                part = node.edge[at : at + STRIDE]
                place = np.minimum(np.searchsorted(own, part), size - 1)
                overlap += int((own[place] == part).sum())
                at += len(part)
                # A set of y n-grams has y - depth left, and needs share * (size + y).
                alive = overlap - (depth + at) + (1 - self.share) * node.longest + 1e-9 >= self.share * size
            if not alive:
                continue
            for m in node.members:
                if self.like.percent * (size + len(self.sets[m]) - overlap) <= 100 * overlap and not same(m):
                    yield m
            stack += [(child, overlap) for child in node.below.values()]


def similar_in(sets: list[np.ndarray], like: Similarity) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a group. ``sets``: in global order."""
    joiner, out = Joiner(sets, like), []
    root = joiner.forest.root
    for x in sorted(range(len(sets)), key=lambda k: len(sets[k])):
        for m in joiner.probe(sets[x], lambda m, x=x: root(m) == root(x)):
            joiner.forest.join(x, m)
            out.append((m, x))
        joiner.insert(x)
    return out


def clustered_sets(rows: DataFrame, clusters: DataFrame, like: Similarity, order: Order, classes: DataFrame | None = None) -> DataFrame:
    """The ordered sets of clustered documents, with cluster and cluster size. Where ids repeat,
    ``classes`` (``doc_id`` and ``KEYS``, each once) tells which sets to take, one for each."""
    few = clusters.count() <= BROADCAST_IDS
    chosen = rows.join(F.broadcast(clusters) if few else clusters, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = gram_sets(piece.column("text"), like.n)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in ("doc_id", "cluster", "members")]
                + [sizes, *(signed(np.array([f(s).sum() for s in sets], np.uint64)) for f in (np.asarray, mix))]
                + [pa.array([order.arranged(s).tobytes() for s in sets], pa.binary())],
                ["doc_id", "cluster", "members", *KEYS, "grams"],
            )

    schema = f"doc_id {kind}, cluster {kind}, members long, n long, s1 long, s2 long, grams binary"
    found = chosen.select("doc_id", "cluster", "members", "text").mapInArrow(run, schema)
    if classes is None:
        return found
    # Copies of a row fall together in each task before the shuffle.
    return found.dropDuplicates(["doc_id", *KEYS]).join(classes.select("doc_id", *KEYS), ["doc_id", *KEYS], "left_semi")


def block(salt: int) -> Column:
    """One of the blocks of a cluster, by the id and the class of a set."""
    return F.pmod(F.xxhash64(F.lit(salt), "doc_id", *KEYS), F.ceil(F.col("members") / GROUP)).cast("int")


def links_within(sets: DataFrame, like: Similarity, salt: int) -> DataFrame:
    """Verified links inside blocks of about ``GROUP`` sets of a cluster."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    cut = sets.withColumn("block", block(salt))
    cut = cut.repartition(shuffle_partitions(sets), "cluster", "block").sortWithinPartitions("cluster", "block", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["cluster", "block"]):
            grams = [np.frombuffer(g, np.uint64) for g in group.column("grams").to_pylist()]
            links = similar_in(grams, like)
            ids = group.column("doc_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array([e[k] for e in links], pa.int64())) for k in (0, 1)], ["a", "b"])

    return cut.select("doc_id", "cluster", "block", "grams").mapInArrow(run, f"a {kind}, b {kind}")


def links_across(sets: DataFrame, roots: DataFrame, like: Similarity) -> DataFrame:
    """Verified links of large clusters that are still in several components. Their largest
    component stays where it is, block by block; every set outside it visits all blocks."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    named = sets.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    parts = named.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("size"))
    cores = parts.groupBy("cluster").agg(F.max_by("root", F.struct("size", "root")).alias("core"), F.count(F.lit(1)).alias("parts"))
    named = named.join(cores.filter("parts > 1").select("cluster", "core"), "cluster")
    blocks = F.ceil(F.col("members") / GROUP).cast("int")
    named = named.withColumns({"own": block(0), "part": F.xxhash64("root")})
    at = F.when(F.col("root") == F.col("core"), F.array("own")).otherwise(F.sequence(F.lit(0), blocks - 1))
    rows = named.withColumn("block", F.explode(at)).withColumn("visits", F.col("block") != F.col("own"))
    rows = rows.select("doc_id", "cluster", "block", "visits", "part", "grams").repartition(shuffle_partitions(sets), "cluster", "block")
    rows = rows.sortWithinPartitions("cluster", "block", "visits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, joiner = None, [], [], None
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                if (row["cluster"], row["block"]) != key:
                    key, ids, parts, joiner = (row["cluster"], row["block"]), [], [], Joiner([], like)
                grams = np.frombuffer(row["grams"], np.uint64)
                if not row["visits"]:  # residents come first; they have met each other before
                    joiner.sets.append(grams)
                    joiner.insert(len(ids))
                    ids.append(row["doc_id"])
                    parts.append(row["part"])
                    continue
                met = {row["part"]}
                for m in joiner.probe(grams, lambda m, met=met: parts[m] in met):
                    met.add(parts[m])
                    found.append((ids[m], row["doc_id"]))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], batch.schema.field("doc_id").type) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def repeated_ids(usable: DataFrame) -> DataFrame:
    """Ids of several rows, and whether their sets differ."""
    ends = [f(k).alias(f"{name}_{k}") for name, f in (("low", F.min), ("high", F.max)) for k in KEYS]
    found = usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), *ends).filter("rows > 1")
    return found.select("doc_id", F.expr(" or ".join(f"low_{k} <> high_{k}" for k in KEYS)).alias("differ"))


def links_of_ids(usable: DataFrame, repeated: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that hold sets of the same id."""
    varied = usable.select("doc_id", *KEYS).join(repeated.filter("differ"), "doc_id", "left_semi").distinct()
    held = materialize(varied.join(classes.select("class", *KEYS), list(KEYS)).select("doc_id", "class").distinct(), "held")
    least = held.groupBy("doc_id").agg(F.min("class").alias("b"))
    return held.join(least, "doc_id").select(F.col("class").alias("a"), "b")


def similar_groups(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` (size of its set) and ``component_id`` (least id reachable by links
    of sets with a Jaccard similarity of ``percent`` or more) of every document."""
    like = Similarity(n, percent)
    rows = texts(docs, id_col, text_col)
    order = frequent(rows, like)
    sets = materialize(described(rows, like, order), "sets")
    usable = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    keys = list(KEYS)
    classes = materialize(usable.groupBy(*keys).agg(F.min("doc_id").alias("class"), F.count(F.lit(1)).alias("copies")), "classes")
    alone = usable.join(classes.select(F.col("class").alias("doc_id"), *keys), ["doc_id", *keys], "left_semi")
    members = materialize(alone.select("doc_id", *keys, "prefix", "sketch").dropDuplicates(["doc_id", *keys]), "members")
    repeated = materialize(repeated_ids(usable), "repeated")
    several = members if repeated.limit(1).count() else None
    rough = components(candidates(members, like)).select(F.col("node").alias("doc_id"), F.col("root").alias("cluster"))
    if several is None:
        sizes = rough.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    else:
        counts = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets"))
        sizes = rough.join(counts, "doc_id").groupBy("cluster").agg(F.sum("sets").alias("members"))
    clusters = materialize(rough.join(sizes, "cluster").select("doc_id", "cluster", "members"), "clusters")
    links = materialize(links_within(clustered_sets(rows, clusters, like, order, several), like, 0), "links")
    if several is not None:
        links = materialize(links.unionByName(links_of_ids(usable, repeated, classes)), "links")
    large = clusters.filter(F.col("members") > GROUP)
    split = large.limit(1).count() > 0
    if split:
        ordered = materialize(clustered_sets(rows, large, like, order, several), "ordered")
        links = materialize(links.unionByName(links_within(ordered, like, 1)), "links")
    roots = materialize(components(links), "roots")
    if split:
        late = materialize(links_across(ordered, roots, like), "links")
        if late.limit(1).count():
            roots = components(links.unionByName(late))
    named = classes.join(roots, classes["class"] == roots["node"], "left")
    named = named.select(*keys, F.coalesce("root", "class").alias("component_id"))
    return (
        sets.select("doc_id", *keys)
        .join(named, keys, "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    )
