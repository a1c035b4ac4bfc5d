"""Runs of periodically repeated words, found by recompression.

The words of several texts become one string of numbers, with a different separator around
every text. Candidates lie on harmonic grids: a run of period q that is at least
``MIN_EXPONENT`` periods long has ``MIN_EXPONENT`` neighbours on the grid of multiples of q
that hold the same word. Texts without such neighbours have no run. Of the others a
run-length grammar is built by recompression: blocks of one symbol and pairs of symbols from
two halves of the alphabet are replaced in turn until one symbol is left. Both depend on
symbols only, so equal stretches are parsed alike but for their edges. A candidate is
extended to both sides by queries for the longest common extension, which climb the grammar
while both sides agree and then go down to the first difference; words themselves are not
compared. The longest stretch of a period q that is not the smallest one of its words is
also found as the stretch of its smallest period.

Words are numbered by their bytes, so results are exact. A task holds the words of about
1 MB of texts, or those of a single longer text (about 100 bytes of memory for each word).

Defined results: NULL, empty and white texts have no words and no runs; every row is its own
text, so repeated ids and rows are answered one by one, NULL ids too; extra columns are left
out; an empty table gives no rows. Of runs with equal exponents the first is the greatest,
of those with one start the shortest period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import pieces, texts
from tapewright.llm.words import mix

#: A run has at least this many words, and this many times its period.
MIN_LENGTH, MIN_EXPONENT = 6, 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.string()), ("runs", pa.list_(_RUN)), ("greatest", _RUN), ("collapsed", pa.string())])


def _renamed(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Grammar:
    """A run-length grammar of a string, level by level.

    ``symbols[k]`` is the string of level k, ``first[k]`` the first phrase of level k - 1 that
    each of its phrases stands for. ``blocks[k]`` tells block from pair compression.
    """

    def __init__(self, string: np.ndarray) -> None:
        self.symbols = [_renamed(string)]
        self.first: list[np.ndarray] = [np.arange(len(string))]
        self.blocks = [False]
        seeds = count(1)
        while len(self.symbols[-1]) > 1:
            self._add(*self._block(self.symbols[-1]), True)
            while len(self.symbols[-1]) > 1 and not self._add(*self._pair(self.symbols[-1], next(seeds)), False):
                pass

    def _add(self, first: np.ndarray, keys: np.ndarray, blocks: bool) -> bool:
        if len(first) == len(self.symbols[-1]):
            return False
        self.symbols.append(_renamed(keys))
        self.first.append(first)
        self.blocks.append(blocks)
        return True

    @staticmethod
    def _block(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal blocks of one symbol; a block is its symbol and its length."""
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        sizes = np.diff(np.r_[first, len(s)])
        return first, s[first] * (len(s) + 1) + sizes

    @staticmethod
    def _pair(s: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a symbol of one half of the alphabet and a next one of the other half.

        The halves are drawn by ``seed``; the order that gives more pairs is used. No symbol
        follows itself, so some seed gives a pair.
        """
        half = (mix(np.arange(s.max() + 1, dtype=np.uint64) + np.uint64(seed << 40)) & np.uint64(1)).astype(bool)[s]
        up, down = ~half[:-1] & half[1:], half[:-1] & ~half[1:]
        head = np.append(up if np.count_nonzero(up) >= np.count_nonzero(down) else down, False)
        first = np.flatnonzero(~np.r_[False, head[:-1]])
        second = np.where(head[first], s[np.minimum(first + 1, len(s) - 1)] + 1, 0)
        return first, s[first] * (len(s) + 1) + second

    def extensions(self, mirrored: bool = False) -> Extensions:
        return Extensions(self, mirrored)


class Extensions:
    """Longest common extensions of positions of a grammar's string, to the right, or to the
    left of the position if ``mirrored``. The string has a symbol that occurs once at each end.

    All phrases of all levels are numbered through, level 0 first.
    """

    def __init__(self, grammar: Grammar, mirrored: bool) -> None:
        sizes = [len(s) for s in grammar.symbols]
        offset = np.r_[0, np.cumsum(sizes)]
        symbols, first, last, parent, in_block = [], [], [], [], []
        for k, s in enumerate(grammar.symbols):
            heads = grammar.first[k]
            tails = np.append(heads[1:], sizes[k - 1] if k else sizes[0]) - 1
            owner = np.full(sizes[k], -1)
            if k + 1 < len(sizes):
                owner = np.repeat(np.arange(sizes[k + 1]), np.diff(np.append(grammar.first[k + 1], sizes[k])))
            if mirrored:
                below = sizes[max(k - 1, 0)]
                s, heads, tails = s[::-1], (below - 1 - tails)[::-1], (below - 1 - heads)[::-1]
                owner = np.where(owner < 0, owner, (sizes[k + 1] if k + 1 < len(sizes) else 0) - 1 - owner)[::-1]
            symbols.append(s)
            first.append(heads + (offset[k - 1] if k else 0))
            last.append(tails + (offset[k - 1] if k else 0))
            parent.append(np.where(owner < 0, owner, owner + offset[k + 1]))
            in_block.append(np.full(sizes[k], k + 1 < len(sizes) and grammar.blocks[k + 1]))
        self.length, self.mirrored = sizes[0], mirrored
        self.symbol, self.first, self.last, self.parent, self.in_block = map(np.concatenate, (symbols, first, last, parent, in_block))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of every pair of different positions."""
        if self.mirrored:
            i, j = self.length - i, self.length - j
        x, y, origin = i.copy(), j.copy(), i
        result = np.zeros(len(i), np.int64)
        rising = np.ones(len(i), bool)
        query = np.arange(len(i))
        while len(query):
            px, py = self.parent[x], self.parent[y]
            climbs = rising & (px >= 0) & (self.first[px] == x) & (self.first[py] == y) & (self.symbol[px] == self.symbol[py])
            goes_on = ~climbs & (self.symbol[x] == self.symbol[y])
            # Within a block as many symbols agree as the shorter rest of both has.
            step = np.where(self.in_block[x], np.minimum(self.last[px] - x, self.last[py] - y) + 1, 1)
            differs = ~climbs & ~goes_on
            done = differs & (x < self.length)
            result[query[done]] = x[done] - origin[done]
            rising &= ~differs
            x = np.where(climbs, px, np.where(goes_on, x + step, self.first[x]))
            y = np.where(climbs, py, np.where(goes_on, y + step, self.first[y]))
            left = ~done
            x, y, origin, rising, query = x[left], y[left], origin[left], rising[left], query[left]
        return result


def chains(string: np.ndarray, begin: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates on the harmonic grids: period, first and last position of every stretch of
    neighbouring grid positions from which ``MIN_EXPONENT`` neighbours hold one symbol.

    ``begin`` are the borders of the texts; the neighbours of a candidate lie in one text.
    """
    periods, firsts, lasts = [], [], []
    for q in range(1, longest // MIN_EXPONENT + 1):
        grid = string[::q]
        equal = grid[1:] == grid[:-1]
        size = len(equal) - MIN_EXPONENT + 2
        if size <= 0:
            break
        hit = equal[:size].copy()
        for k in range(1, MIN_EXPONENT - 1):
            hit &= equal[k : size + k]
        at = np.flatnonzero(hit)
        ends = np.searchsorted(begin, (at * q, (at + MIN_EXPONENT - 1) * q), "right")
        at = at[ends[0] == ends[1]]
        if len(at):
            gap = np.flatnonzero(np.diff(at) > 1)
            firsts.append(at[np.r_[0, gap + 1]] * q)
            lasts.append(at[np.r_[gap, len(at) - 1]] * q)
            periods.append(np.full(len(gap) + 1, q))
    if not periods:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(periods), np.concatenate(firsts), np.concatenate(lasts)


def extended(string: np.ndarray, period: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Runs through the candidates, as rows of start, end and smallest period, in order."""
    grammar = Grammar(string)
    right, left = grammar.extensions(), grammar.extensions(mirrored=True)
    found = [np.zeros((0, 3), np.int64)]
    while len(period):
        start = first - left(first, first + period)
        end = first + period + right(first, first + period)
        long = end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
        found.append(np.stack([start, end, period], axis=1)[long])
        # The next grid position of the stretch that this run does not explain.
        first = np.maximum(first + period, first + -(-(end - period - first) // period) * period)
        more = first <= last
        period, first, last = period[more], first[more], last[more]
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.r_[True, (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)][: len(rows)]
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of(documents: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of every document (start, end, period in words)."""
    none = np.zeros((0, 3), np.int64)
    if not documents:
        return []
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    numbers = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in documents]

    def joined(members: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """One string with separators, and where every member begins in it."""
        parts = [np.array([-1])]
        for k, member in enumerate(members):
            parts += [numbers[member], np.array([-2 - k])]
        sizes = np.array([len(numbers[m]) + 1 for m in members])
        return np.concatenate(parts), np.r_[1, 1 + np.cumsum(sizes)]

    string, begin = joined(list(range(len(documents))))
    period, first, last = chains(string, begin, max(map(len, documents)))
    if not len(period):
        return [none] * len(documents)
    owner = np.searchsorted(begin, first, "right") - 1
    members = np.unique(owner)
    string, moved = joined(members.tolist())
    place = np.searchsorted(members, owner)
    shift = moved[place] - begin[owner]
    rows = extended(string, period, first + shift, last + shift)
    place = np.searchsorted(moved, rows[:, 0], "right") - 1
    out = [none] * len(documents)
    for k in np.unique(place):
        mine = rows[place == k]
        out[members[k]] = mine - np.array([moved[k], moved[k], 0])
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]


def _greatest(runs: list[dict]) -> dict | None:
    """The run of greatest exact exponent; the first of equals."""
    best = None
    for run in runs:
        if best is None or run["length"] * best["period"] > best["length"] * run["period"]:
            best = run
    return best


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        # Splitting bytes parts them at 0x20 and 0x09 to 0x0D only.
        documents = [t.encode().split() for t in batch.column("text").to_pylist()]
        rows: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "runs": [], "greatest": [], "collapsed": []}
        for words, runs in zip(documents, runs_of(documents), strict=True):
            listed = [{"start": s, "length": e - s, "period": q} for s, e, q in runs.tolist()]
            rows["runs"].append(listed)
            rows["greatest"].append(_greatest(listed))
            rows["collapsed"].append(b" ".join(collapsed(words, runs)).decode())
        yield pa.RecordBatch.from_pydict(rows, schema=_OUT)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: all ``runs`` by start and period, the ``greatest`` and the ``collapsed`` text.

    No shuffle. Starts count words from 0.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType
    run = "struct<start: bigint, length: bigint, period: bigint>"
    found = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInArrow(
        _answers, f"doc_id string, runs array<{run}>, greatest {run}, collapsed string"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def looped(docs: DataFrame) -> DataFrame:
    """``documents`` with the last part of some texts made periodic.

    With h the checksum of the id and g = h div 10, texts with h divisible by 10 repeat p words
    from word g mod n on; rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = texts(docs).select("doc_id", "text", h.alias("h"))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(chosen, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def word(w: Column, i: Column) -> Column:
        source = (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
        return F.when(i < F.col("a"), w).otherwise(F.get(F.col("words"), source))

    text = F.when(F.col("n") > 0, F.array_join(F.transform("words", word), " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the greatest run and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"greatest.{name}").alias(name) for name in ("start", "length", "period")),
        F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
