"""Benchmark search, quality ranking and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import similar
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapewright.llm import leak_search, pairwise_quality
from tapewright.llm.words import Words


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def test_wand_returns_all_above_the_threshold():
    rng = random.Random(1)
    index = leak_search.Index([(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(3, 30)))) for i in range(300)])
    for _ in range(100):
        terms = sorted({rng.randrange(len(index.terms)) for _ in range(rng.randint(1, 60))})
        score: dict[int, float] = {}
        for t in terms:
            for item, weight in zip(*index.postings[t]):
                score[item] = score.get(item, 0.0) + weight
        got = dict(index.search(terms, 0.1))
        assert set(got) == {k for k, v in score.items() if v + 1e-9 >= 0.1}
        assert all(abs(got[k] - score[k]) < 1e-9 for k in got)


def test_words_hash_alike_wherever_they_stand():
    words = Words(pa.array(["Ab cd  ef", "", "x", "cd ef gh ab"]))
    assert words.first.tolist() == [0, 3, 3, 4, 8]
    assert words.hash[0] == words.hash[7] and words.hash[1] == words.hash[4] and len(set(words.hash.tolist())) == 5
    assert words.grams(2)[1].tolist() == [0, 1, 4, 5, 6]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 200])
def test_leaks(spark, shard_bytes):
    rng = random.Random(2)
    items = [(i, sentence(rng, 30) + "? " + sentence(rng, 8)) for i in range(12)]
    docs = []
    for k in range(60):
        words = sentence(rng, 2000 if k % 7 == 0 else 100).split()
        if k % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = items[k % 12][1].upper().replace("?", " !").split()
        docs.append((k, " ".join(words)))
    found = leak_search.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), shard_bytes=shard_bytes)
    rows = found.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(k, k % 12) for k in range(0, 60, 3)}
    # Scores are those of an index of all items, however many shards there are.
    index = leak_search.Index(items)
    plain = {(docs[h[0]][0], *h[1:]) for h in leak_search.matches(index, pa.array([t for _, t in docs]))}
    assert {tuple(r) for r in rows} == plain


def test_every_window_against_full_scoring(spark):
    """Block-max WAND over windows gives what scoring every item for every window gives."""
    rng = random.Random(8)
    items = [(k, sentence(rng, rng.choice((2, 4, 9, 40))) + "? " + sentence(rng, rng.choice((1, 3, 12)))) for k in range(30)]
    index = leak_search.Index(items)
    texts = []
    for k in range(40):
        words = sentence(rng, 300).split()
        for item in rng.sample(items, 2):
            inside = item[1].split()
            if rng.random() < 0.5:
                del inside[rng.randrange(len(inside))]
            at = rng.randrange(len(words))
            words[at:at] = inside
        texts.append(" ".join(words))

    def all_of(self, terms, threshold):
        score = {}
        for t in terms:
            for item, weight in zip(*self.postings[t], strict=True):
                score[item] = score.get(item, 0.0) + weight
        return [(k, v) for k, v in sorted(score.items()) if v + 1e-9 >= threshold]

    full = leak_search.Index(items)
    full.bound = np.full_like(full.bound, 1.0)  # no window is passed over
    full.search = all_of.__get__(full)
    rounded = lambda found: sorted((r, i, round(s, 9), *rest) for r, i, s, *rest in found)
    got = rounded(leak_search.matches(index, pa.array(texts)))
    assert got == rounded(leak_search.matches(full, pa.array(texts))) and len(got) > 20


def test_items_that_repeat_an_id_are_reported_once(spark):
    rng = random.Random(4)
    item = sentence(rng, 20)
    items = [(1, item), (1, item), (1, item + " more"), (2, sentence(rng, 20))]
    docs = spark.createDataFrame([(5, f"so {item} more and so on")], "doc_id long, text string")
    for shard_bytes in (1 << 20, 10):
        found = leak_search.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), shard_bytes=shard_bytes).collect()
        assert [(r.doc_id, r.item_id, r.overlap) for r in found] == [(5, 1, 1.0)]


def test_short_sequences_hash_like_single_ones():
    hashes = Words(pa.array(["a b c d e f"])).hash
    for n in range(1, 7):
        assert leak_search.sequences(hashes, n).tolist() == [leak_search.sequence(hashes[k : k + n]) for k in range(7 - n)]


def test_leak_needs_question_and_answer(spark):
    rng = random.Random(3)
    question, answer = sentence(rng, 40), sentence(rng, 10)
    docs = [(1, f"{question} and {answer}"), (2, question + " " + sentence(rng, 12)), (3, sentence(rng, 50))]
    items = [(7, f"{question}? {answer}")]
    found = leak_search.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]


def test_leak_edges(spark):
    items = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "two words", 0), (None, "alpha beta gamma delta epsilon zeta", 0)], "item_id long, text string, doc_id int")
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (None, "so two words here", 0), (4, "x alpha beta gamma delta epsilon zeta", 0), (4, "x alpha beta gamma delta epsilon zeta", 0)],
        "doc_id long, text string, score int",
    )
    assert sorted(((r.doc_id, r.item_id) for r in leak_search.leaks(docs, items).collect()), key=str) == [(4, None), (4, None), (None, 3)]
    assert leak_search.leaks(docs, items.limit(0)).collect() == [] and leak_search.leaks(docs.limit(0), items).collect() == []


def test_ranking_learns(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = pairwise_quality.scored(docs, pairwise_quality.learn(docs, labels)).join(labels, "doc_id").filter(pairwise_quality.held_out()).collect()
    assert len(rows) > 50
    assert sum((r.score >= pairwise_quality.BORDER) == (r.quality == 1) for r in rows) / len(rows) > 0.95


def test_ranking_of_repeated_ids_is_the_same_on_every_run(spark):
    rng = random.Random(6)
    rows = [(k % 40, sentence(rng, 30 + k % 50) + "#" * (k % 9)) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    fits = []
    for parts, part in ((1, rows), (6, rows[::-1])):
        ranking = pairwise_quality.learn(spark.createDataFrame(part, "doc_id long, text string").repartition(parts), labels)
        fits.append(ranking.score(pairwise_quality.matrix([t for _, t in rows])).tolist())
    assert fits[0] == fits[1]


def test_ranking_edges(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "a b", 9), (3, "x " * 50_000, 9), (3, "x", 9)], "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7), (3, 0), (3, 1)], "doc_id long, quality int")
    got = pairwise_quality.scored(docs, pairwise_quality.learn(docs, none))
    assert got.columns == ["doc_id", "text", "score"] and [r.score for r in got.collect()] == [0.5] * 5
    assert pairwise_quality.scored(docs.limit(0), pairwise_quality.learn(docs.limit(0), none.limit(0))).collect() == []


def test_border_lies_between_the_classes():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 0.2, (200, len(pairwise_quality.FEATURES))), rng.normal(-1, 0.2, (50, len(pairwise_quality.FEATURES)))
    ranking = pairwise_quality.fit(good, bad, 0.2)
    assert (ranking.score(good) > pairwise_quality.BORDER).all() and (ranking.score(bad) < pairwise_quality.BORDER).all()


def labelled(rng, n_good, n_bad):
    """Rows that are not held out, with unlike features and labels that overlap."""
    rows, k = [], 0
    while len(rows) < n_good + n_bad:
        k += 1
        if zlib.crc32(str(k).encode()) % 5:
            good = len(rows) < n_good
            rows.append((k, sentence(rng, rng.randint(3, 12)) + "#" * rng.randint(0, 4 if good else 9) + "A" * rng.randint(0, 6), int(good)))
    rng.shuffle(rows)
    x = pairwise_quality.matrix([t for _, t, _ in rows])
    return rows, x, np.array([label for *_, label in rows])


def tables(spark, rows):
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")


def border_of(ranking, x, label):
    s = np.sort(ranking.strength(x))
    n_bad = int((label == 0).sum())
    return (s[n_bad - 1] + s[n_bad]) / 2


def test_ranking_uses_every_labelled_row(spark):
    rows, x, label = labelled(random.Random(11), 4700, 4500)
    ranking = pairwise_quality.learn(*tables(spark, rows))
    assert np.allclose(ranking.mean, x.mean(0), rtol=1e-12, atol=1e-15)
    assert np.allclose(ranking.scale, np.maximum(x.std(0), 1e-6), rtol=1e-9)
    assert abs(ranking.border - border_of(ranking, x, label)) < 1e-9


@pytest.mark.parametrize("n_good, n_bad, group", [(400, 300, 50), (3, 500, 40), (500, 1, 40), (60, 60, 1)])
def test_ranking_in_groups(spark, monkeypatch, n_good, n_bad, group):
    monkeypatch.setattr(pairwise_quality, "NEAR", 5)
    monkeypatch.setattr(pairwise_quality, "BINS", 4)
    rows, x, label = labelled(random.Random(n_good + group), n_good, n_bad)
    docs, labels = tables(spark, rows)
    ranking = pairwise_quality.learn(docs, labels, group=group)
    assert np.allclose(ranking.mean, x.mean(0), rtol=1e-12, atol=1e-15) and ranking.weights.any()
    assert abs(ranking.border - border_of(ranking, x, label)) < 1e-9
    # Every group has rows of both labels, and every row is one group's own.
    found = docs.join(labels, "doc_id").selectExpr("doc_id", "quality as label", f"array_repeat(doc_id * 1d, {len(pairwise_quality.FEATURES)}) as x")
    parts = pairwise_quality.grouped(found, {0: n_bad, 1: n_good}, group).collect()
    assert all(r.good and r.bad for r in parts) or group == 1
    for side, k in (("good", 1), ("bad", 0)):
        ids = [np.frombuffer(r[side]).reshape(-1, len(pairwise_quality.FEATURES))[np.frombuffer(r[f"own_{side}"], bool), 0] for r in parts]
        assert sorted(np.concatenate(ids).astype(int).tolist()) == sorted(i for i, _, q in rows if q == k)
    if group > 1:
        whole = pairwise_quality.fit(x[label == 1], x[label == 0], n_bad / len(rows))
        assert np.corrcoef(whole.strength(x), ranking.strength(x))[0, 1] > 0.98


def test_border_among_equal_scores():
    x = np.zeros((90, len(pairwise_quality.FEATURES)))
    x[:40, 0] = 1
    x[85:, 0] = -1
    ranking = pairwise_quality.fit(x[:60], x[60:], 1 / 3)
    assert ranking.border == ranking.strength(x)[50]
    ranking = pairwise_quality.fit(x[:40], x[40:], 50 / 90)
    assert ranking.border == (ranking.strength(x)[50] + ranking.strength(x)[0]) / 2


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "test")
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    before, after = kept["n-gram Jaccard join"]
    groups = similar({d: r.text for d, r in before.items()}, 5, 80)
    assert set(after) == {d for d, (_, c) in groups.items() if d == c}
    before, after = kept["benchmark decontamination"]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert set(after) == {d for d, r in before.items() if not any(i in r.text for i in items)}
    before, after = kept["PII"]
    assert set(before) == set(after) and any(r.text != before[d].text for d, r in after.items())
    assert all("@" not in r.text and r.n_chars == len(r.text) for r in after.values())
    before, after = kept["BPE encoding and decoding"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding(), library.no_truncation()
    for d, r in after.items():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(before[d].text, add_special_tokens=False).ids


def test_pipeline_stages_keep_odd_rows(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "mail a@b.cc", "en", "s", 11), (None, None, None, None, None), (3, "same words", "en", "s", 10), (3, "same words", "en", "s", 10)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens").collect()
    assert sorted(map(str, (r.doc_id for r in got))) == ["1", "2", "3", "None", "None"]
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
        assert empty.count() == 0 and F.col("doc_id") is not None
