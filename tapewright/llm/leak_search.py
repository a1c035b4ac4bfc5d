"""Benchmark decontamination by BM25 search with block-max WAND.

The test items are the indexed documents, the training passages are the queries. Terms are
three-word sequences, so that a passage shares terms only with items it resembles. Impacts
are BM25 weights divided by the item's own score, so one threshold fits all items. Every
window of every training document is a query: its terms are looked up by array
operations, and windows whose best possible score reaches the threshold go through
block-max WAND, which returns every item at or above it. Each hit is verified: the five-word
sequences of the item's question and of its answer must occur in the window.

Windows are twice as long as the longest item and overlap by one item length, so no
occurrence falls between two. The index is built from at most ``SHARD_BYTES`` of items at
a time and sent to the executors; more items mean more index shards, each with its own
pass over the documents. Frequencies, mean length and window width are those of all items,
counted by Spark, so no score depends on the number of shards. No shuffle of texts.

Defined results: NULL or empty items and texts match nothing; an item with fewer than five
words matches where its whole word sequence occurs; items that repeat an id are searched
as separate texts, in one shard, and reported once, with the best match; equal items count
once; a document that repeats an id is reported for each of its rows; a very long text is
searched window by window, whole; extra columns are ignored; an empty table on either side
gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tapewright.llm.columns import pieces, texts, whole_text
from tapewright.llm.words import MARKS, SPACE, Words, sequence, sequences
from tapewright.session import materialize

TERM_WORDS = 3
SHINGLE_WORDS = 5
#: Share of an item's own score that a passage must reach to be retrieved.
THRESHOLD = 0.4
#: Share of the shingles of an item, and of its question and answer each, that must occur.
OVERLAP, PART_OVERLAP = 0.8, 0.5
K1, B = 1.2, 0.75
BLOCK = 64
#: Text of one index shard, which every executor holds.
SHARD_BYTES = 16 << 20
SEPARATORS = SPACE + MARKS


def question_and_answer(text: str) -> tuple[str, str]:
    """Up to the last question mark and after it; without one, two halves of the words."""
    cut = text.rfind("?") + 1
    if 0 < cut < len(text.rstrip()):
        return text[:cut], text[cut:]
    places = [m.start() for m in re.finditer(r"\S+", text)]
    cut = places[len(places) // 2] if places else 0
    return text[:cut], text[cut:]


def grams(text: str, n: int) -> np.ndarray:
    """Distinct n-word sequences of a text, or its whole word sequence if it is shorter."""
    words = Words(pa.array([text]), SEPARATORS)
    if 0 < len(words.hash) < n:
        return np.array([sequence(words.hash)], np.uint64)
    return np.unique(words.grams(n)[0])


class Statistics(NamedTuple):
    """What BM25 and the windows need to know of all items: their number, the mean number of
    terms, the longest and the shortest in words, and in how many items a term occurs."""

    items: int
    mean: float
    longest: int
    shortest: int
    terms: np.ndarray
    df: np.ndarray


def term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of every item, and its length in words."""
    for piece in pieces(batches):
        for text in piece.column("text").to_pylist():
            words = len(Words(pa.array([text]), SEPARATORS).hash)
            if words:
                own = grams(text, TERM_WORDS).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"term": own, "n_terms": np.full(len(own), len(own)), "n_words": np.full(len(own), words), "first": np.arange(len(own)) == 0})


def statistics_of(tests: DataFrame) -> tuple[Statistics, DataFrame]:
    """Statistics of all items without their terms, and a table of the terms' frequencies."""
    schema = "term long, n_terms long, n_words long, first boolean"
    counted = materialize(tests.select("text").mapInArrow(term_rows, schema), "terms")
    n, terms, longest, shortest = counted.filter("first").agg(F.count(F.lit(1)), F.sum("n_terms"), F.max("n_words"), F.min("n_words")).first()
    df = materialize(counted.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    return Statistics(n, (terms or 0) / max(1, n), longest or 0, shortest or 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)), df


def of_shard(whole: Statistics, df: DataFrame, part: DataFrame) -> Statistics:
    """The statistics with the frequencies of the terms of one shard: as many as its text has."""
    own = part.select("text").mapInArrow(term_rows, "term long, n_terms long, n_words long, first boolean").select("term").distinct()
    rows = df.join(own, "term", "left_semi").collect()
    terms = np.array([r["term"] for r in rows], np.int64).astype(np.uint64)
    order = np.argsort(terms)
    return whole._replace(terms=terms[order], df=np.array([r["df"] for r in rows], np.int64)[order])


class Index:
    """Inverted index of items with block maxima.

    Without ``statistics`` the items are all there are.
    """

    def __init__(self, items: list[tuple[object, str]], statistics: Statistics | None = None) -> None:
        items = [(i, t) for i, t in items if t and len(Words(pa.array([t]), SEPARATORS).hash)]
        self.ids = [i for i, _ in items]
        parts = [question_and_answer(t) for _, t in items]
        self.parts = [tuple(grams(p, SHINGLE_WORDS) for p in (q, a, t)) for (q, a), (_, t) in zip(parts, items)]
        lengths = [len(Words(pa.array([t]), SEPARATORS).hash) for _, t in items]
        terms = [grams(t, TERM_WORDS) for _, t in items]
        self.terms, df = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms]), return_counts=True)
        if statistics is None:
            mean = sum(map(len, terms)) / max(1, len(terms))
            statistics = Statistics(len(items), mean, max(lengths, default=0), min(lengths, default=0), self.terms, df)
        self.longest, self.shortest, mean = statistics.longest, statistics.shortest, statistics.mean
        df = statistics.df[np.searchsorted(statistics.terms, self.terms)]
        idf = np.log1p((statistics.items - df + 0.5) / (df + 0.5))
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for k, own in enumerate(terms):
            at = np.searchsorted(self.terms, own)
            weight = idf[at] * (K1 + 1) / (1 + K1 * (1 - B + B * len(own) / mean))
            for t, w in zip(at.tolist(), (weight / weight.sum()).tolist()):
                postings[t].append((k, w))
        self.postings = [([k for k, _ in p], [w for _, w in p]) for p in postings]
        self.block_max = [[max(w[b : b + BLOCK]) for b in range(0, len(w), BLOCK)] for _, w in self.postings]
        self.bound = np.array([max(b) for b in self.block_max] or [0.0])
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def lookup(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` that are terms, and which."""
        maybe = np.flatnonzero(self.sieve[(values & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(maybe) or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term = np.minimum(np.searchsorted(self.terms, values[maybe]), len(self.terms) - 1)
        hit = self.terms[term] == values[maybe]
        return maybe[hit], term[hit]

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose score reaches ``threshold``."""
        lists = [(*self.postings[t], self.block_max[t], float(self.bound[t])) for t in terms]
        at, out = [0] * len(lists), []
        slack = 1e-9
        while True:
            live = sorted((lists[k][0][at[k]], k) for k in range(len(lists)) if at[k] < len(lists[k][0]))
            total, pivot = 0.0, None
            for j, (item, k) in enumerate(live):
                total += lists[k][3]
                if total + slack >= threshold:
                    pivot = item
                    break
            if pivot is None:
                return out
            while j + 1 < len(live) and live[j + 1][0] == pivot:
                j += 1
            front = [k for _, k in live[: j + 1]]
            # Move shallowly to the blocks that may hold the pivot, and bound again.
            for k in front:
                at[k] = self._seek(lists[k][0], at[k], pivot)
            here = [k for k in front if at[k] < len(lists[k][0])]
            if sum(lists[k][2][at[k] // BLOCK] for k in here) + slack < threshold:
                # No item up to the nearest block end, or the next list, can reach it.
                ends = [lists[k][0][min(len(lists[k][0]), (at[k] // BLOCK + 1) * BLOCK) - 1] + 1 for k in here]
                others = [item for item, _ in live[j + 1 :]]
                step = max(pivot + 1, min([*ends, *others], default=pivot + 1))
                for k in here:
                    at[k] = self._seek(lists[k][0], at[k], step)
                continue
            match = [k for k in here if lists[k][0][at[k]] == pivot]
            score = sum(lists[k][1][at[k]] for k in match)
            if score + slack >= threshold:
                out.append((pivot, score))
            for k in match:
                at[k] += 1

    @staticmethod
    def _seek(items: list[int], start: int, target: int) -> int:
        while start < len(items) and items[start] < target:
            start += BLOCK if start + BLOCK < len(items) and items[start + BLOCK - 1] < target else 1
        return start


def overlap(part: np.ndarray, found: np.ndarray) -> float:
    return float(np.isin(part, found).mean()) if len(part) else 1.0


def matches(index: Index, piece: pa.Array) -> list[tuple[int, object, float, float, float, float]]:
    """Verified items of each text: row, item id, score, overlaps of item, question, answer."""
    words = Words(piece, SEPARATORS)
    width = max(2 * index.longest, 64)
    stride = width - index.longest
    values, at = words.grams(TERM_WORDS)
    place, term = index.lookup(values)
    row_of = np.searchsorted(words.first, at[place], "right") - 1
    out = []
    rows = np.unique(row_of).tolist()
    if index.shortest < SHINGLE_WORDS:
        rows = range(len(piece))  # items may be shorter than a term
    for row in rows:
        mine = row_of == row
        where, which = at[place[mine]] - words.first[row], term[mine]
        count = int(words.first[row + 1] - words.first[row])
        best: dict[object, tuple] = {}
        windows = range(0, max(1, count - index.longest), stride)
        order = np.argsort(where, kind="stable")
        where, which = where[order], which[order]
        rank = np.concatenate([[0.0], np.cumsum(index.bound[which])])
        for w in windows:
            a, b = np.searchsorted(where, w), np.searchsorted(where, w + width - TERM_WORDS, "right")
            short = _short(index, words.hash[words.first[row] + w : words.first[row] + min(count, w + width)])
            if rank[b] - rank[a] + 1e-9 < THRESHOLD and not short:
                continue
            terms = np.unique(np.concatenate([which[a:b], np.array(short, np.int64)])).astype(int).tolist()
            found = None
            for item, score in index.search(terms, THRESHOLD):
                if found is None:
                    found = _shingles(words, row, w, min(count, w + width), index)
                question, answer, whole = (overlap(p, found) for p in index.parts[item])
                if whole + 1e-9 >= OVERLAP and min(question, answer) + 1e-9 >= PART_OVERLAP:
                    key = index.ids[item]
                    best[key] = max(best.get(key, (-1.0,)), (whole, score, question, answer))
        out += [(row, key, score, whole, question, answer) for key, (whole, score, question, answer) in best.items()]
    return out


def _short(index: Index, hashes: np.ndarray) -> list[int]:
    """Terms that are whole items of fewer words than a term."""
    if index.shortest >= TERM_WORDS:
        return []
    return [t for n in range(1, TERM_WORDS) for t in index.lookup(sequences(hashes, n))[1].tolist()]


def _shingles(words: Words, row: int, a: int, b: int, index: Index) -> np.ndarray:
    """Hashes of the five-word sequences of a window, and of shorter ones that are item parts."""
    hashes = words.hash[words.first[row] + a : words.first[row] + b]
    part = Words.__new__(Words)
    part.hash, part.first = hashes, np.array([0, len(hashes)])
    whole = part.grams(SHINGLE_WORDS)[0]
    return np.concatenate([whole, *(sequences(hashes, n) for n in range(1, SHINGLE_WORDS))])


OUT = "doc_id {doc}, item_id {item}, score double, overlap double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Pairs of a training document and a test item that it contains, with the best window's
    score and overlaps."""
    rows = texts(docs, id_col, text_col)
    tests = items.select("item_id", whole_text().alias("text")).dropDuplicates()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    schema = OUT.format(doc=rows.schema["doc_id"].dataType.simpleString(), item=tests.schema["item_id"].dataType.simpleString())
    if shards > 1:
        tests = materialize(tests, "items")
        whole, df = statistics_of(tests)
    found = None
    for k in range(shards):
        # Bounded: one shard of the items, about ``shard_bytes`` of text, those of one id together.
        part = tests.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k) if shards > 1 else tests
        index = Index([(r["item_id"], r["text"]) for r in part.collect()], of_shard(whole, df, part) if shards > 1 else None)
        if shards > 1 and not index.ids:
            continue
        hits = rows.mapInArrow(_search(index, to_arrow_type(tests.schema["item_id"].dataType)), schema)
        found = hits if found is None else found.unionAll(hits)
    return found


def _search(index: Index, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            hits = matches(index, piece.column("text")) if index.ids else []
            rows = pa.array([h[0] for h in hits], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").take(rows),
                    pa.array([h[1] for h in hits], item_type),
                    *(pa.array([h[k] for h in hits], pa.float64()) for k in range(2, 6)),
                ],
                ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return run
