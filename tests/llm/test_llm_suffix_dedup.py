"""Repeat removal against counting all windows; suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from brute import repeats
from pyspark.sql import functions as F

from tapewright.llm import suffix_dedup


def removed(spark, docs, length, gram, crowd=suffix_dedup.CROWD, schema="doc_id long, text string"):
    rows = suffix_dedup.without_repeats(spark.createDataFrame(docs, schema), length, gram, crowd=crowd)
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return [tuple(r) for r in rows.select("doc_id", "n_bytes", total, F.size("removed"), F.sha2("kept", 256)).collect()]


def test_suffix_array_is_sorted():
    random.seed(1)
    for _ in range(300):
        s = np.array([random.randrange(random.choice([1, 2, 3, 10, 3000])) for _ in range(random.randint(1, 70))])
        want = sorted(range(len(s)), key=lambda i: tuple(s[i:]))
        assert suffix_dedup.suffix_array(s).tolist() == want
        assert suffix_dedup.doubled(s).tolist() == want


def test_common_prefixes_reach():
    random.seed(2)
    s = np.array([random.choice([1, 2]) for _ in range(500)] * 2)
    order = suffix_dedup.suffix_array(s)
    got = suffix_dedup.reaching(s, order, 12)
    for k in range(1, len(order)):
        a, b = s[order[k - 1] :][:12], s[order[k] :][:12]
        assert got[k] == (len(a) == len(b) == 12 and (a == b).all())


def texts(seed):
    random.seed(seed)
    base = ["".join(random.choice("ab é") for _ in range(random.choice([50, 300, 900]))) for _ in range(6)]
    docs = {}
    for i in range(50):
        parts = (random.choice(base)[random.randint(0, 200) :] + "".join(random.choice("xyz") for _ in range(random.randint(0, 30))) for _ in range(4))
        docs[i] = random.choice(["a", "ab"]) * random.randint(1, 1500) if i % 9 == 0 else "".join(parts)
    return docs


@pytest.mark.parametrize("length, gram, crowd", [(400, 160, 8192), (40, 15, 8192), (40, 15, 3)])
def test_same_as_counting_windows(spark, length, gram, crowd):
    docs = texts(length + crowd)
    got = {r[0]: r[1:] for r in removed(spark, list(docs.items()), length, gram, crowd)}
    assert got == dict(zip(docs, repeats(list(docs.values()), length)))


def test_edges(spark):
    long = "".join(chr(97 + k * k % 26) for k in range(3000))
    # NULL and empty texts, a NULL id, a repeated row, a text of exactly the length, extra columns.
    docs = [(1, None, 5), (2, "", 5), (None, "x" * 10, 5), (3, long, 5), (3, long, 5), (4, "q" * 400, 5), (5, "q" * 401, 5)]
    got = sorted(removed(spark, docs, 400, 160, schema="doc_id long, text string, ranges int"), key=str)
    by = {(r[0], r[1]): r[2:4] for r in got}
    assert by[(1, 0)] == by[(2, 0)] == (0, 0)
    assert by[(None, 10)] == (0, 0)
    assert by[(3, 3000)] == (3000, 1) and len(got) == 7
    assert by[(4, 400)] == (400, 1) and by[(5, 401)] == (401, 1)  # each window of q starts elsewhere too
    assert removed(spark, [], 400, 160) == []


@pytest.mark.parametrize("again", [3, None])
def test_repeated_rows_carry_their_spans_once(spark, again):
    random.seed(9)
    long = "".join(random.choice("abcdefgh") for _ in range(3000))
    docs = [(again, long)] * 40 + [(5, long[:1500] + "z" * 600), (6, "y" + long[1000:])]
    rows = suffix_dedup.texts(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").withColumn("version", F.xxhash64("text"))
    ranges = {r.doc_id: r.ranges for r in suffix_dedup.repeated_ranges(rows, 400, 160).collect()}
    assert set(ranges) == {again, 5, 6}
    assert all(len(found) == len(set(found)) for found in ranges.values())
    # One copy of each context is fetched, however many rows repeat it.
    asked = rows.select("doc_id", "version").distinct().filter("doc_id <=> " + ("NULL" if again is None else str(again)))
    zero = [F.lit(0).cast("long").alias(c) for c in ("gram", "digest", "copies", "contexts")] + [F.lit(0).alias(c) for c in ("shift", "first", "more")]
    assert suffix_dedup.fetched(rows, asked.select("*", *zero), 400).count() == 1
    got = removed(spark, docs, 400, 160)
    assert got.count((again, 3000, 3000, 1, hashlib.sha256(b"").hexdigest())) == 40
    assert {r[0]: r[1:4] for r in got}[6] == (2001, 2000, 1)
