"""The Jaccard join against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import similar

from tapewright.llm import components, trie_join


def joined(spark, docs, n=4, percent=85, schema="doc_id long, text string"):
    return sorted((tuple(r) for r in trie_join.similar_groups(spark.createDataFrame(docs, schema), n, percent).collect()), key=str)


def near_copies(seed, many=60):
    random.seed(seed)
    base = [[f"w{random.randrange(3000)}" for _ in range(random.choice([3, 12, 60, 200]))] for _ in range(6)]
    line = "this line stands in a great many of the texts".split()
    docs = {}
    for i in range(many):
        words = list(random.choice(base))
        for _ in range(random.randint(0, max(1, len(words) // 25))):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        docs[i] = " ".join(words + (line if i % 3 else []))
    return docs


@pytest.mark.parametrize("group, crowd", [(512, 4096), (5, 4)])
def test_same_as_all_pairs(spark, monkeypatch, group, crowd):
    monkeypatch.setattr(trie_join, "GROUP", group)
    monkeypatch.setattr(trie_join, "CROWD", crowd)
    docs = near_copies(group)
    got = {d: (n, c) for d, n, c in joined(spark, list(docs.items()))}
    assert got == similar(docs, 4, 85)


def test_trie_finds_every_component():
    random.seed(3)
    like = trie_join.Similarity(4, 80)
    for _ in range(80):
        base = [random.sample(range(10**6), random.choice([4, 20, 120])) for _ in range(3)]
        sets = []
        for _ in range(random.randint(2, 30)):
            own = list(random.choice(base))
            for _ in range(random.randint(0, max(1, len(own) // 6))):
                own[random.randrange(len(own))] = random.randrange(10**6)
            sets.append(np.array(sorted(set(own)), np.uint64))
        got, want = trie_join.Forest(len(sets)), trie_join.Forest(len(sets))
        for a, b in trie_join.similar_in(sets, like):
            got.join(a, b)
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    want.join(a, b)
        assert [got.root(k) for k in range(len(sets))] == [want.root(k) for k in range(len(sets))]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    for size in (10, 900, 3000, 9000):
        a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
        for other in (a[: size // 2], np.unique(np.r_[a[size // 10 :], rng.integers(0, 1 << 62, size).astype(np.uint64)])):
            assert trie_join.apart(trie_join.sketch(a), trie_join.sketch(other)) <= len(np.setxor1d(a, other))
    assert np.array_equal(trie_join.unpacked(trie_join.packed(a)), (a & np.uint64((1 << 40) - 1)).astype(np.int64))


def test_edges(spark):
    same = " ".join(f"a{k}" for k in range(30))
    docs = [(5, same, 1), (3, same.upper(), 1), (3, same.upper(), 1), (None, same, 1), (7, None, 1), (8, " \n", 1), (9, "one two", 1), (4, "ONE  two", 1)]
    got = joined(spark, docs, schema="doc_id long, text string, n int")
    assert got == sorted([(5, 27, 3), (3, 27, 3), (3, 27, 3), (None, 27, None), (7, 0, 7), (8, 0, 8), (9, 1, 4), (4, 1, 4)], key=str)
    assert joined(spark, []) == []


def test_classes_of_one_id_belong_together(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    got = joined(spark, [(5, a), (3, a), (5, b), (4, b), (6, "other words stand here")])
    assert got == sorted([(5, 27, 3), (3, 27, 3), (5, 27, 3), (4, 27, 3), (6, 1, 6)], key=str)


def test_repeated_id_in_many_blocks(spark, monkeypatch):
    """A hot id: copies of a row are one set, and its different texts are dealt over the blocks."""
    monkeypatch.setattr(trie_join, "GROUP", 5)
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(base[:150] + [f"x{k}"] + base[151:]) for k in range(40)]
    docs = [(1, t) for t in texts for _ in range(3)] + [(2, texts[0] + " more"), (3, "far away from all of them")]
    got = joined(spark, docs)
    assert [r[0::2] for r in got] == [(1, 1)] * 120 + [(2, 1), (3, 3)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    like = trie_join.Similarity(4, 85)
    order = trie_join.frequent(rows, like)
    classes = trie_join.described(rows, like, order).dropDuplicates(["doc_id", "n", "s1", "s2"])
    clusters = spark.createDataFrame([(1, 1, 41), (2, 1, 41)], "doc_id long, cluster long, members long")
    sets = trie_join.clustered_sets(rows, clusters, like, order, classes)
    dealt = [r["count"] for r in sets.groupBy(trie_join.block(0)).count().collect()]
    assert sum(dealt) == 41 and len(dealt) > 4 and max(dealt) < 20


def test_similarity_at_the_border(spark):
    """17 of 20 is 0.85 and links; 16 of 20 does not."""
    words = [f"w{k}" for k in range(40)]
    base = " ".join(words)
    assert [r[2] for r in joined(spark, [(2, base), (1, base + " w40"), (3, " ".join(words[:30]))])] == [1, 1, 3]
    like = trie_join.Similarity(4, 85)
    a = np.arange(0, 20, dtype=np.uint64)
    assert trie_join.similar_in([a, a[:17]], like) and not trie_join.similar_in([a, a[:16]], like)


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(k, 500) for k in range(300, 400)] + [(600 + k, 601 + k) for k in range(90)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    forest = trie_join.Forest(800)
    for a, b in links:
        forest.join(a, b)
    assert got == {k: forest.root(k) for a, b in links if a != b for k in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
