"""Quality scores learnt from preference pairs (Bradley-Terry).

Every labelled text has a strength, linear in its features; a good text is preferred to a
bad one with probability sigmoid(difference of strengths). The weights minimise the
logistic loss over pairs of a good and a bad text, which needs only the differences of
their features. The strength at the quantile of the labelled rows' scores that equals
their share of bad texts becomes the border, and a logistic curve maps it to ``BORDER``.

The fit uses every labelled row. Rows are dealt by hash into groups of both labels, each
row is paired within its group, and a step of Newton's method adds up what the groups
return; the border is found by counting scores in ever narrower ranges. So the driver holds
sums and counts of the groups, never their rows. Features and scores are computed by passes
without a shuffle of the texts.

Defined results: a NULL or empty text has all features zero and a score like any other;
rows that repeat an id are scored alike; rows with a NULL id are scored but never used for
the fit, like labels other than 0 and 1, and ids whose labels contradict each other. With
fewer than one row of either label nothing can be learnt: every score is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import pieces, texts
from tapewright.session import materialize

#: Score of the border between bad and good texts.
BORDER = 0.3
#: Rows of the more frequent label in one group of the fit, on average.
GROUP = 4096
#: Rows of the other label in one group, on average; if they are too few, groups share them.
RIVALS = 256
#: Ranges of scores counted at once, and scores that need not be narrowed down further.
BINS, NEAR = 256, 1 << 16
#: Good texts that each bad text is compared with, and the other way round.
PAIRS = 24
RIDGE = 1e-3
STEPS = 30
FEATURES = (
    "log_words word_length distinct_words repeated_next repeated_trigrams repeated_lines upper digits blanks marks symbols "
    "exclamations bars other_bytes symbol_words one_letter_words"
).split()

# Characters counted as symbols, and as ordinary marks.
SYMBOLS = "#*$%&<>@^_~=+\\{}[]`"
MARKS = ".,;:?'\"()-/"


def _at(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("ascii"), np.uint8)


def features(text: str) -> list[float]:
    """Shares and averages that tell prose from junk; zeros for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = int(seen.sum())
    letters = max(1, int(seen[65:91].sum() + seen[97:123].sum() + seen[128:].sum()))
    trigrams = n - 2
    lines = [line for line in text.split("\n") if line]
    return [
        math.log1p(n),
        min(20.0, size / n),
        len(set(words)) / n**0.8,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / trigrams if trigrams > 0 else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        int(seen[65:91].sum()) / letters,
        int(seen[48:58].sum()) / size,
        int(seen[32] + seen[10] + seen[9]) / size,
        int(seen[_at(MARKS)].sum()) / size,
        int(seen[_at(SYMBOLS)].sum()) / size,
        int(seen[33]) / size,
        int(seen[124]) / size,
        int(seen[128:].sum()) / size,
        sum(not w[-1].isalnum() and w[-1] not in MARKS for w in words) / n,
        sum(map((1).__eq__, map(len, words))) / n,
    ]


def matrix(values: list[str]) -> np.ndarray:
    return np.array([features(t) for t in values], float).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Ranking:
    """Weights of standardised features, and the strength that scores ``BORDER``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    border: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        z = self.slope * (self.strength(x) - self.border) + math.log(BORDER / (1 - BORDER))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass(frozen=True)
class Group:
    """Features of the good and bad rows that are paired with each other. A row that several
    groups share is its ``own`` in one of them."""

    good: np.ndarray
    bad: np.ndarray
    own_good: np.ndarray
    own_bad: np.ndarray

    def own(self) -> np.ndarray:
        return np.concatenate([self.good[self.own_good], self.bad[self.own_bad]])


#: Calls a function on every group and returns the results in the order of the groups.
Each = Callable[[Callable[[Group], np.ndarray]], list[np.ndarray]]


def pairs(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Differences of ``PAIRS`` pairs for each row of the more frequent label; every row has some."""
    if not len(good) or not len(bad):
        return np.zeros((0, len(FEATURES)))
    turn = np.arange(max(len(good), len(bad)))
    stride = 7919 if len(good) % 7919 else 7907  # reaches all good rows
    return np.concatenate([good[(turn * stride + k * 104729) % len(good)] - bad[(turn + k) % len(bad)] for k in range(PAIRS)])


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float) -> Ranking:
    """The ranking of rows that make up one group. ``share_bad``: share of bad among all labelled rows."""
    group = Group(good, bad, np.ones(len(good), bool), np.ones(len(bad), bool))
    return solved(lambda f: [f(group)], share_bad)


def solved(each: Each, share_bad: float) -> Ranking:
    """Newton's method on the pairwise loss over all groups."""
    total = sum(each(lambda g: np.r_[g.own_good.sum(), g.own_bad.sum(), g.own().sum(0)]), np.zeros(2 + len(FEATURES)))
    n_good, n_bad, n = int(total[0]), int(total[1]), int(total[0] + total[1])
    empty = Ranking(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0, 1.0)
    if not n_good or not n_bad:
        return empty
    mean = total[2:] / n
    scale = np.maximum(np.sqrt(sum(each(lambda g: ((g.own() - mean) ** 2).sum(0))) / n), 1e-6)

    def pulls(g: Group, w: np.ndarray) -> np.ndarray:
        """Number of pairs, their gradient and their curvature."""
        d = pairs(*(np.clip((x - mean) / scale, -8, 8) for x in (g.good, g.bad)))
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # that the bad one wins
        return np.r_[len(d), d.T @ p, ((d * (p * (1 - p))[:, None]).T @ d).ravel()]

    w = np.zeros(len(mean))
    for _ in range(STEPS):
        at = w  # what the groups are sent
        found = sum(each(lambda g: pulls(g, at)))
        gradient = RIDGE * w - found[1 : 1 + len(w)] / found[0]
        curve = found[1 + len(w) :].reshape(len(w), -1) / found[0] + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    border, far = quantile(each, Ranking(mean, scale, w, 0.0, 1.0), share_bad, n_good, n_bad)
    return Ranking(mean, scale, w, border, min(1.0, 12 / max(1e-9, far)))


def quantile(each: Each, ranking: Ranking, share_bad: float, n_good: int, n_bad: int) -> tuple[float, float]:
    """The middle between the strength up to which ``share_bad`` of the mass of all labelled rows
    lies and the next one, and the largest distance of a strength from it."""
    mass, target = np.array([(1 - share_bad) / n_good, share_bad / n_bad]), share_bad - 1e-12

    def strengths(g: Group, low: float = -math.inf, high: float = math.inf) -> list[np.ndarray]:
        both = (ranking.strength(x[own]) for x, own in ((g.good, g.own_good), (g.bad, g.own_bad)))
        return [s[(s >= low) & (s <= high)] for s in both]

    def ends(low: float, high: float) -> tuple[float, float]:
        found = np.array(each(lambda g: np.array([f(np.concatenate(strengths(g, low, high)), initial=i) for f, i in ((np.min, math.inf), (np.max, -math.inf))])))
        return float(found[:, 0].min()), float(found[:, 1].max())

    least, most = low, high = ends(-math.inf, math.inf)
    inside, below = n_good + n_bad, np.zeros(2)
    while inside > NEAR and low < high:
        edges = np.linspace(low, high, BINS + 1)[1:-1]
        lo, hi = low, high
        counts = sum(each(lambda g: np.concatenate([np.bincount(np.searchsorted(edges, s, "right"), minlength=BINS) for s in strengths(g, lo, hi)]))).reshape(2, BINS)
        reached = np.flatnonzero(mass @ (below[:, None] + counts.cumsum(1)) >= target)
        k = int(reached[0]) if len(reached) else int(np.flatnonzero(counts.sum(0))[-1])
        below, inside = below + counts[:, :k].sum(1), int(counts[:, k].sum())
        low, high = ends(*(float(e) for e in (low if k == 0 else edges[k - 1], high if k == BINS - 1 else np.nextafter(edges[k], -math.inf))))

    def distinct(g: Group) -> np.ndarray:
        """The least strength above the range, and in it the different ones with their good and bad rows."""
        good, bad = strengths(g, low, high)
        values, which = np.unique(np.concatenate([good, bad]), return_inverse=True)
        rows = [np.bincount(x, minlength=len(values)) for x in (which[: len(good)], which[len(good) :])]
        above = np.concatenate(strengths(g, np.nextafter(high, math.inf)))
        return np.r_[above.min(initial=math.inf), values, *rows]

    found = each(distinct)
    values, good, bad = (np.concatenate(c) for c in zip(*(x[1:].reshape(3, -1) for x in found)))
    values, which = np.unique(values, return_inverse=True)
    rows = np.array([np.bincount(which, c) for c in (good, bad)])
    upto = mass @ (below[:, None] + rows.cumsum(1))
    at = min(int(np.searchsorted(upto, target)), len(values) - 1)
    if rows[:, at].sum() > 1 and upto[at] - mass[1 if rows[1, at] else 0] >= target:  # an equal one follows
        after = values[at]
    else:
        after = values[at + 1] if at + 1 < len(values) else min(x[0] for x in found)
    border = float(values[at] + (after if math.isfinite(after) else values[at])) / 2
    return border, max(most - border, border - least)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows kept away from the fit: the checksum of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", group: int = GROUP) -> Ranking:
    """Fit on all labelled rows, paired in groups of about ``group`` rows of the more frequent label."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    none = fit(np.zeros((0, len(FEATURES))), np.zeros((0, len(FEATURES))), 0.0)
    if len(counts) < 2:
        return none
    # The features are joined with the labels, so the texts need no shuffle.
    # Of rows that repeat an id one text speaks for all, the same on every run.
    rows = measured(texts(docs).filter(F.col("doc_id").isNotNull() & ~held_out())).join(known.select("doc_id", "label"), "doc_id")
    rows = materialize(rows.groupBy("doc_id", "label").agg(F.min(F.struct("version", "x"))["x"].alias("x")), "labelled")
    found = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(found) < 2:
        return none
    stored = materialize(grouped(rows, found, group), "groups")

    def each(f: Callable[[Group], np.ndarray]) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, good, bad, own_good, own_bad in zip(*(c.to_pylist() for c in batch.columns)):
                    x = (np.frombuffer(b).reshape(-1, len(FEATURES)) for b in (good, bad))
                    value = f(Group(*x, *(np.frombuffer(b, bool) for b in (own_good, own_bad))))
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([value.tolist()], pa.list_(pa.float64()))], ["number", "value"])

        return [np.array(r["value"], float) for r in sorted(stored.mapInArrow(run, "number long, value array<double>").collect(), key=lambda r: r["number"])]

    return solved(each, counts[0] / sum(counts.values()))


def measured(rows: DataFrame) -> DataFrame:
    """``doc_id``, digest of the text and features of all rows."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x = matrix(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("version"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "version", "x"])

    digest = F.md5(F.col("text").cast("binary")).alias("version")
    return rows.select("doc_id", digest, "text").mapInArrow(run, f"doc_id {kind}, version string, x array<double>")


def grouped(rows: DataFrame, found: dict[int, int], group: int) -> DataFrame:
    """One row for each group: its number, and the features of its good and bad rows by id with
    whether they are its own. ``found``: rows of each label."""
    groups = -(-max(found.values()) // group)
    rivals = max(1, min(RIVALS, group // 2))
    copies = {k: min(groups, -(-rivals * groups // n)) for k, n in found.items()}
    last = F.when(F.col("label") == 0, copies[0] - 1).otherwise(copies[1] - 1)
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.withColumn("number", F.pmod(F.xxhash64("doc_id") % groups + F.col("copy"), F.lit(groups)))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        good = rows.column("label").to_numpy() == 1
        own = rows.column("copy").to_numpy() == 0
        x = np.array(rows.column("x").combine_chunks().flatten(), float).reshape(-1, len(FEATURES))
        parts = [rows.column("number")[:1].combine_chunks(), *(pa.array([p.tobytes()], pa.binary()) for p in (x[good], x[~good], own[good], own[~good]))]
        return pa.Table.from_arrays(parts, ["number", "good", "bad", "own_good", "own_bad"])

    schema = "number long, good binary, bad binary, own_good binary, own_bad binary"
    return dealt.select("number", "doc_id", "label", "copy", "x").groupBy("number").applyInArrow(pack, schema)


def scored(docs: DataFrame, ranking: Ranking, score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``score_col`` (replaced if there is one)."""
    rows = docs.select(*(c for c in docs.columns if c != score_col))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            values = [t or "" for t in piece.column("text").to_pylist()]
            score = ranking.score(matrix(values))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(score, pa.float64())], [*piece.schema.names, score_col])

    return rows.mapInArrow(run, f"{schema}, `{score_col}` double")
