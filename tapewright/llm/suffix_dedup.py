"""Exact removal of repeated byte strings with sharded suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Every
window of that length is assigned to an anchor inside it: the least hash among its
``GRAM``-byte strings. Equal windows have equal anchors at the same place, so whatever can
repeat meets at its anchor's hash. Consecutive windows with the same anchor form a context.

1. Anchors are counted; contexts whose anchor occurs once are done.
2. Equal contexts (by anchor hash and digest, 128 bits together) are one, with their number.
3. Where an anchor has different contexts, one copy of each goes to the anchor's shard, and
   the shard's suffix array is built by induced sorting: suffixes are classified, the
   leftmost-smaller substrings sorted and named, the reduced text sorted recursively, and
   the array induced from it bucket by bucket. Permuted common prefixes of neighbours, at
   sampled places and between bounds elsewhere, tell which windows are equal.
4. Contexts get the starts of their repeated windows, documents their byte ranges.

Anchors with more than ``CROWD`` different contexts are spread over several shards by their
contexts; there, windows that remain alone in a shard are counted by digest across shards.

Defined results: a NULL or empty text has no bytes, and one shorter than ``length`` keeps
all; rows that repeat an id with the same text are copies of each other and lose all that
is long enough; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import pieces, shuffle_partitions, texts
from tapewright.llm.words import between, flat, mix, sums
from tapewright.session import materialize

LENGTH = 400
GRAM = 160
#: Bits of the two sieves of anchor hashes.
SIEVE_BITS = 1 << 26
#: Different contexts of one anchor in one shard, about.
CROWD = 8192
#: Bytes of contexts sorted in one suffix array, at least, unless the task has fewer.
SHARD_BYTES = 2 << 20
#: Text bytes whose anchors are searched at once; longer texts are cut with an overlap.
STRETCH = 2 << 20
#: Every so many places, common prefixes are compared in full.
SAMPLE = 8
#: Size of a table of ranges that may be broadcast instead of shuffling the texts to it.
BROADCAST_BYTES = 48 << 20


# Anchors


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` values: prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Hash and place of the anchor, first and last start of the windows that have it, for one text.

    Of equal hashes in a window the last counts, so the choice depends on the window alone.
    """
    found: list[tuple[np.ndarray, ...]] = []
    windows = len(raw) - length + 1
    for a in range(0, max(0, windows), STRETCH):
        part = raw[a : min(a + STRETCH, windows) + length - 1]
        codes = mix(part.astype(np.uint64) + np.uint64(1))
        total = sums(codes)
        at = np.arange(len(part) - gram + 1)
        hashes = between(total, at, at + gram)
        low = np.uint64((1 << 24) - 1)
        ranked = (hashes & ~low) | (low - at.astype(np.uint64))
        where = (low - (_least(ranked, length - gram + 1) & low)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        last = np.r_[first[1:], len(where)] - 1
        found.append((hashes[where[first]], where[first] + a, first + a, last + a))
    if not found:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def anchored(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """All contexts of all documents: anchor hash, digest, document, window starts, and the
    anchor's distance from the first of them."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            raw, borders = flat(piece.column("text"))
            view = memoryview(raw)
            parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)]
            for k in range(len(piece)):
                a, b = int(borders[k]), int(borders[k + 1])
                if b - a < length:
                    continue
                hashes, at, first, last = anchors(raw[a:b], length, gram)
                digest = [xxhash.xxh3_64_intdigest(view[a + f : a + t + length]) for f, t in zip(first.tolist(), last.tolist())]
                values = (np.full(len(first), k), hashes.view(np.int64), np.array(digest, np.uint64).view(np.int64), first, last - first, at - first)
                for part, value in zip(parts, values):
                    part.append(value)
            row, hashes, digest, first, more, shift = (np.concatenate(p) for p in parts)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes),
                    pa.array(digest),
                    piece.column("doc_id").take(owner),
                    piece.column("version").take(owner),
                    pa.array(first),
                    pa.array(more.astype(np.int32)),
                    pa.array(shift.astype(np.int32)),
                ],
                ["gram", "digest", "doc_id", "version", "first", "more", "shift"],
            )

    schema = f"gram long, digest long, doc_id {kind}, version long, first long, more int, shift int"
    return rows.select("doc_id", "version", "text").mapInArrow(run, schema)


def sieve(found: DataFrame) -> np.ndarray:
    """Bits of anchor hashes that occur twice; others may share their bit. Of fixed size."""
    twice = found.groupBy("gram").count().filter("count > 1")
    bit = F.col("gram").bitwiseAND(F.lit(SIEVE_BITS - 1))
    mask = F.expr("shiftleft(1L, cast(gram & 31 as int))").alias("mask")
    rows = twice.select(F.shiftright(bit, 5).alias("place"), mask).groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(SIEVE_BITS // 32, np.uint32)
    bits[rows.column("place").to_numpy()] = rows.column("mask").to_numpy().astype(np.uint32)
    return bits


def sifted(found: DataFrame, bits: np.ndarray) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(bits)  # SIEVE_BITS, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("gram").to_numpy() & (SIEVE_BITS - 1)
            yield batch.filter(pa.array((shared.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1))

    return found.mapInArrow(run, found.schema)


# Suffix arrays


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. ``s``: non-negative integers; the end counts as least."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    width = int(s.max()) + 1
    if width > max(1024, n // 16):
        return doubled(s)
    if width < 1 << 15:
        s = s.astype(np.int16)
    # Classify: a suffix is smaller than the next one if its first different symbol is.
    rises = np.zeros(n, bool)
    step = np.flatnonzero(s[:-1] != s[1:])
    rises[step] = s[step] < s[step + 1]
    following = np.searchsorted(step, np.arange(n - 1))
    inside = following < len(step)
    rises[:-1][inside] = rises[step[following[inside]]]
    least = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1  # leftmost of smaller ones
    if not len(least):
        return induced(s, width, rises, least)
    order = induced(s, width, rises, least)
    # Sorted leftmost-smaller substrings get names; equal ones, the same.
    mark = np.zeros(n, bool)
    mark[least] = True
    order = order[mark[order]]
    ends = np.r_[least[1:] + 1, n]
    total = sums(mix(s.astype(np.uint64) + np.uint64(1)))
    value = between(total, least, ends)
    place = np.empty(n, np.int64)
    place[least] = np.arange(len(least))
    ranked = place[order]
    fresh = np.r_[True, value[ranked[1:]] != value[ranked[:-1]]]
    fresh[1:] |= (ranked[1:] == len(least) - 1) | (ranked[:-1] == len(least) - 1)  # the last one ends the text
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 < len(least):
        reduced = np.empty(len(least), np.int64)
        reduced[ranked] = names
        ranked = suffix_array(reduced)
    return induced(s, width, rises, least[ranked])


def induced(s: np.ndarray, width: int, rises: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Induce the order of all suffixes from that of the leftmost-smaller ones, bucket by bucket."""
    n = len(s)
    count = np.bincount(s, minlength=width)
    start = np.cumsum(count) - count
    out = np.full(n, -1, np.int32)
    symbol = s[least]
    group = np.argsort(symbol, kind="stable")
    own = np.bincount(symbol, minlength=width)
    seeds = np.split(least[group], np.cumsum(own)[:-1])
    used = np.flatnonzero(count)

    head = start.copy()

    def forward(at: np.ndarray) -> None:
        at = at[at > 0] - 1
        at = at[~rises[at]]
        _append(out, s, at, head)

    _append(out, s, np.array([n - 1]), head)  # what the end induces
    for c in used.tolist():
        done = start[c]
        while done < head[c]:
            upto = head[c]
            forward(out[done:upto])
            done = upto
        forward(seeds[c])

    tail = start + count

    def backward(at: np.ndarray) -> None:
        at = at[at > 0] - 1
        at = at[rises[at]]
        _prepend(out, s, at, tail)

    for c in used.tolist()[::-1]:
        done = start[c] + count[c]
        while done > tail[c]:
            upto = tail[c]
            backward(out[upto:done][::-1])
            done = upto
        backward(out[start[c] : head[c]][::-1])
    return out


def _append(out: np.ndarray, s: np.ndarray, at: np.ndarray, head: np.ndarray) -> None:
    """Put suffixes, in order, behind the heads of their buckets."""
    if not len(at):
        return
    symbol = s[at]
    group = np.argsort(symbol, kind="stable")
    symbol = symbol[group]
    border = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
    size = np.diff(np.r_[border, len(symbol)])
    rank = np.arange(len(symbol)) - np.repeat(border, size)
    out[head[symbol] + rank] = at[group]
    head[symbol[border]] += size


def _prepend(out: np.ndarray, s: np.ndarray, at: np.ndarray, tail: np.ndarray) -> None:
    """Put suffixes, from the greatest down, before the tails of their buckets."""
    if not len(at):
        return
    symbol = s[at]
    group = np.argsort(symbol, kind="stable")
    symbol = symbol[group]
    border = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
    size = np.diff(np.r_[border, len(symbol)])
    rank = np.arange(len(symbol)) - np.repeat(border, size)
    out[tail[symbol] - 1 - rank] = at[group]
    tail[symbol[border]] -= size


def doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks, for texts with too many symbols for buckets. Only
    suffixes that still share their rank are sorted again."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    fresh = np.r_[True, s[order[1:]] != s[order[:-1]]]
    # The rank is the place of the first suffix of its kind, so ranks of others stay.
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    k = 1
    while True:
        open_ = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
        if not len(open_):
            return order
        at = order[open_]
        own, second = rank[at], rank[np.minimum(at + k, n)]
        turn = np.lexsort((second, own))
        at, own, second = at[turn], own[turn], second[turn]
        order[open_] = at
        fresh[open_] = np.r_[True, (own[1:] != own[:-1]) | (second[1:] != second[:-1])]
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(fresh[open_], np.arange(len(open_)), 0))]
        k *= 2


def reaching(s: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each entry of the suffix array shares ``length`` symbols with the one before it.

    Common prefixes are taken in text order: that of a place is at most one less than that of
    the place before it, so full comparisons at every ``SAMPLE`` places bound those between.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([s.astype(np.int16), np.full(length + 2 * SAMPLE + 64, -1, np.int16)])
    most = length + SAMPLE

    def common(at: np.ndarray, upto: int) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        live = np.flatnonzero(before[at] >= 0)
        step = 16
        while len(live):
            a, b = at[live] + out[live], before[at[live]] + out[live]
            reach = np.arange(step)
            a, b = np.minimum(a[:, None] + reach, len(padded) - 1), np.minimum(b[:, None] + reach, len(padded) - 1)
            same = (padded[a] == padded[b]) & (padded[a] >= 0)
            whole = same.all(1)
            out[live] += np.where(whole, step, np.argmin(same, 1))
            live = live[whole & (out[live] < upto)]
            step = min(64, 2 * step)
        return out

    sampled = np.arange(0, n, SAMPLE)
    known = common(sampled, most)
    at = np.arange(n)
    low = known[at // SAMPLE] - at % SAMPLE
    above = np.minimum(at // SAMPLE + 1, len(sampled) - 1)
    high = np.where(at // SAMPLE + 1 < len(sampled), known[above] + (sampled[above] - at), most)
    yes = low >= length
    open_ = np.flatnonzero(~yes & (high >= length) & (before >= 0))
    yes[open_] = common(open_, length) >= length
    return yes[order]


def equal_windows(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal windows of the contexts: class, context and start of every window."""
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[begin + sizes] = 0  # a border is less than all bytes
    order = suffix_array(symbols)
    same = reaching(symbols, order, length)
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)[order]
    start = order - begin[owner]
    valid = start + length <= sizes[owner]
    label = np.cumsum(~same)
    return label[valid], owner[valid], start[valid]


# Shards


def trimmed(grams: np.ndarray, shifts: np.ndarray, contexts: list[bytes], length: int, gram: int, step: int = 20) -> list[tuple[int, int]]:
    """For each context of whole groups, the window starts that may recur: how far other
    contexts of its anchor agree to the left and to the right of it bounds them."""
    n = len(contexts)
    reach = np.zeros((2, n), np.int64)
    for side in (0, 1):
        alive = np.arange(n)
        for far in range(step, length - gram + 1, step):
            keys = []
            for k in alive.tolist():
                a = int(shifts[k])
                part = contexts[k][a - far : a] if side == 0 and a >= far else contexts[k][a + gram : a + gram + far] if side else b""
                keys.append(xxhash.xxh3_64_intdigest(part, int(grams[k]) & 0xFFFFFFFF) if len(part) == far else 0)
            keys = np.array(keys, np.uint64)
            alive, keys = alive[keys > 0], keys[keys > 0]
            _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
            alive = alive[count[inverse] > 1]
            if not len(alive):
                break
            reach[side, alive] = far
    out = []
    for k in range(n):
        a = int(shifts[k])
        low = max(0, a - int(reach[0, k]) - step + 1)
        high = min(len(contexts[k]), a + gram + int(reach[1, k]) + step - 1) - length
        out.append((low, high))
    return out


RANGES = "array<struct<a:int,b:int>>"


def _spans(starts: np.ndarray) -> list[dict[str, int]]:
    """Ascending starts as ranges of consecutive ones."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(a), "b": int(b)} for a, b in zip(starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]])] if len(starts) else []


def shard_verdicts(rows: dict[str, list], length: int, gram: int, crowd: int) -> tuple[list[tuple], list[tuple]]:
    """Repeated starts of the contexts of whole groups, and open windows of split groups."""
    contexts, split = rows["bytes"], [c > crowd for c in rows["contexts"]]
    weight = np.array(rows["copies"], np.int64)
    keep = trimmed(np.array(rows["gram"], np.int64), np.array(rows["shift"], np.int64), contexts, length, gram)
    keep = [(0, len(c) - length) if s else k for k, c, s in zip(keep, contexts, split)]
    chosen = [k for k, (low, high) in enumerate(keep) if low <= high]
    if not chosen:
        return [], []
    label, owner, start = equal_windows([contexts[k][keep[k][0] : keep[k][1] + length] for k in chosen], length)
    owner = np.array(chosen)[owner]
    start = start + np.array([low for low, _ in keep])[owner]
    label = np.unique(label, return_inverse=True)[1]
    total = np.bincount(label, weight[owner])[label]
    order = np.lexsort((start, owner))
    owner, start, total, label = owner[order], start[order], total[order], label[order]
    sure, verdicts, pending = total > 1, [], []
    for k in np.unique(owner[sure]).tolist():
        if weight[k] == 1:
            a, b = np.searchsorted(owner, [k, k + 1])
            verdicts.append((rows["gram"][k], rows["digest"][k], _spans(start[a:b][sure[a:b]])))
    told: set[int] = set()
    for k, at, t, name in zip(owner.tolist(), start.tolist(), total.tolist(), label.tolist()) if any(split) else ():
        if split[k] and not (t > 1 and name in told):
            told.add(name)
            key = xxhash.xxh3_128_digest(contexts[k][at : at + length])
            pending.append((*np.frombuffer(key, np.int64).tolist(), min(int(t), 2), rows["gram"][k], rows["digest"][k], at if t == 1 else None))
    return verdicts, pending


def verdicts(contexts: DataFrame, length: int, gram: int, crowd: int) -> DataFrame:
    """``gram``, ``digest`` and the repeated starts of contexts that occur once themselves.

    ``contexts``: the different contexts of anchors that have several, with their bytes.
    """
    salt = F.pmod("digest", F.ceil(F.col("contexts") / crowd))
    cut = contexts.withColumn("salt", salt).repartition(shuffle_partitions(contexts), "gram", "salt").sortWithinPartitions("gram", "salt", "digest")
    names = ["gram", "digest", "salt", "copies", "contexts", "shift", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in names}
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            sure, open_ = shard_verdicts(held, length, gram, crowd) if held["gram"] else ([], [])
            held, size = {c: [] for c in names}, 0
            ranges = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            n, m = len(sure), len(open_)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([v[0] for v in sure] + [v[3] for v in open_], pa.int64()),
                    pa.array([v[1] for v in sure] + [v[4] for v in open_], pa.int64()),
                    pa.array([v[2] for v in sure] + [None] * m, ranges),
                    pa.array([None] * n + [v[0] for v in open_], pa.int64()),
                    pa.array([None] * n + [v[1] for v in open_], pa.int64()),
                    pa.array([None] * n + [v[2] for v in open_], pa.int32()),
                    pa.array([None] * n + [v[5] for v in open_], pa.int32()),
                ],
                ["gram", "digest", "ranges", "w1", "w2", "weight", "start"],
            )

        last = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["gram"], row["salt"])
                if size >= SHARD_BYTES and key != last:
                    yield flush()
                last = key
                size += len(row["bytes"])
                for c in names:
                    held[c].append(row[c])
        yield flush()

    schema = f"gram long, digest long, ranges {RANGES}, w1 long, w2 long, weight int, start int"
    done = materialize(cut.select(*names).mapInArrow(run, schema), "shards")
    # Windows of split groups that stayed alone in their shard are counted across shards.
    open_ = done.filter("w1 is not null")
    twice = open_.groupBy("w1", "w2").agg(F.sum("weight").alias("total")).filter("total > 1").select("w1", "w2")
    late = open_.filter("start is not null").join(twice, ["w1", "w2"], "left_semi")
    late = late.select("gram", "digest", F.array(F.struct(F.col("start").alias("a"), F.col("start").alias("b"))).alias("ranges"))
    return done.filter("ranges is not null").select("gram", "digest", "ranges").unionByName(late)


def fetched(rows: DataFrame, requests: DataFrame, length: int) -> DataFrame:
    """The bytes of the requested contexts, each cut once out of its document."""
    wanted = requests.groupBy("doc_id", "version").agg(F.collect_list(F.struct("gram", "digest", "copies", "contexts", "shift", "first", "more")).alias("asked"))
    wanted = materialize(wanted.withColumnRenamed("doc_id", "wanted_id").withColumnRenamed("version", "wanted_version"), "requests")
    joined = rows.join(_small(wanted, "asked", 80), F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("version") == F.col("wanted_version")))
    if rows.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").limit(1).count():
        # Rows that repeat an id with the same text are asked once.
        joined = joined.dropDuplicates(["doc_id", "version"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out = []
            for text, asked in zip(piece.column("text").to_pylist(), piece.column("asked").to_pylist()):
                raw = text.encode("utf-8")
                for a in asked:
                    out.append(a | {"bytes": raw[a["first"] : a["first"] + a["more"] + length]})
            yield pa.RecordBatch.from_pylist(
                out,
                pa.schema([("gram", pa.int64()), ("digest", pa.int64()), ("copies", pa.int64()), ("contexts", pa.int64()), ("shift", pa.int32()), ("bytes", pa.binary())]),
            )

    return joined.select("text", "asked").mapInArrow(run, "gram long, digest long, copies long, contexts long, shift int, bytes binary")


def _small(df: DataFrame, column: str, item_bytes: int) -> DataFrame:
    """Broadcast if the rows and the items of their array ``column`` fit ``BROADCAST_BYTES``, else
    shuffle and let adaptive execution split."""
    size = df.agg(F.sum(F.lit(64) + item_bytes * F.size(column))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def repeated_ranges(rows: DataFrame, length: int, gram: int, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``version`` and the byte ranges covered by repeated strings, as start and end."""
    found = materialize(anchored(rows, length, gram), "anchors")
    found = sifted(found, sieve(found))
    places = F.min(F.struct("doc_id", "version", "first", "more", "shift")).alias("at")
    unique = materialize(found.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("copies"), places), "contexts")
    several = unique.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1")
    requests = unique.join(several, "gram").select("gram", "digest", "copies", "contexts", "at.*")
    some = verdicts(fetched(rows, requests, length), length, gram, crowd)
    whole = unique.filter("copies > 1").select("gram", "digest", F.lit(None).cast(RANGES).alias("ranges"))
    hits = found.join(whole.unionByName(some), ["gram", "digest"])
    all_of = F.array(F.struct(F.lit(0).alias("a"), F.col("more").alias("b")))
    each = hits.select("doc_id", "version", "first", F.explode(F.coalesce("ranges", all_of)).alias("r"))
    span = F.struct((F.col("first") + F.col("r.a")).alias("start"), (F.col("first") + F.col("r.b") + length).alias("end"))
    # Rows that repeat an id with the same text bring the same spans; sets drop them before the shuffle.
    spans = each.groupBy("doc_id", "version").agg(F.collect_set(span).alias("ranges"))
    # Contexts overlap, so the runs they make together are far fewer than they are.
    kind = spans.schema["doc_id"].dataType.simpleString()
    return spans.mapInArrow(_joined, f"doc_id {kind}, version long, ranges array<struct<start:int,end:int>>")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        found = [[{"start": a, "end": b} for a, b in merged(r)] for r in batch.column("ranges").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), pa.array(found, runs)], ["doc_id", "version", "ranges"])


def merged(ranges: list[dict[str, int]]) -> list[tuple[int, int]]:
    """Ranges joined where they touch."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], r["end"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (maximal byte runs) and ``kept`` (the other bytes)."""
    if not 0 < gram <= length:
        raise ValueError("an anchor must fit into a window")
    rows = texts(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    ranges = materialize(repeated_ranges(rows, length, gram, crowd), "ranges").withColumnsRenamed({"doc_id": "range_id", "version": "range_version"})
    joined = rows.join(_small(ranges, "ranges", 40), F.col("doc_id").eqNullSafe(F.col("range_id")) & (F.col("version") == F.col("range_version")), "left")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sizes, removed, kept = [], [], []
            for text, found in zip(piece.column("text").to_pylist(), piece.column("ranges").to_pylist()):
                raw, runs = text.encode("utf-8"), merged(found or [])
                ends = [0, *(b for _, b in runs)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(raw)])))
                sizes.append(len(raw))
                removed.append([{"start": a, "end": b} for a, b in runs])
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return joined.select("doc_id", "text", "ranges").mapInArrow(run, schema)
