import random
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest

from tapewright.llm import merkle_manifest, pareto_mix, periodic_runs, positions

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASHING = ("rank", "at", "part", "total", "node", "tree_id", "root", "size", "key", "draw", "words", "runs", "h", "g", "n", "a", "p", "file", "row", "target", "before")

ODD_TEXTS = [None, "", " \t\n", "a", "a a a a a a", "x y x y x y x y z", "Ünï Ünï Ünï Ünï Ünï Ünï", "A B A B", "w " * 40_000, "p q r " * 5 + "p"]


def odd_rows():
    """NULL and repeated ids, NULL sources, repeated rows, one source with most rows."""
    rng = random.Random(7)
    rows = []
    for k, text in enumerate(ODD_TEXTS):
        rows += [(k, text, "en", "hot", 5), (None, text, None, None, None), (7, text, "de", "", 1)]
    for k in range(60):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        rows.append((100 + k, " ".join(words), "en", "hot" if k % 3 else f"s{k % 7}", k))
    return rows + rows[:9] * 3


def with_clashes(df):
    for name in CLASHING:
        df = df.withColumn(name, df["text"])
    return df


@pytest.fixture(scope="module")
def odd(spark):
    return with_clashes(spark.createDataFrame(odd_rows(), DOCS))


def listed(df):
    return Counter(tuple(r) for r in df.collect())


# --- periodic runs ---


def test_common_extensions_against_plain_ones():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(2, 50)
        s = np.r_[-1, [rng.randrange(rng.choice((1, 2, 3))) for _ in range(n)], -2]
        i, j = (np.array(x) for x in zip(*[(a, b) for a in range(1, n + 1) for b in range(a + 1, n + 2)], strict=True))
        grammar = periodic_runs.Grammar(s)

        def plain(a, b, step):
            size = 0
            while s[a + size * step] == s[b + size * step]:
                size += 1
            return size

        right = [plain(a, b, 1) for a, b in zip(i, j, strict=True)]
        left = [plain(a - 1, b - 1, -1) for a, b in zip(i, j, strict=True)]
        assert grammar.extensions()(i, j).tolist() == right
        assert grammar.extensions(mirrored=True)(i, j).tolist() == left


def test_grammar_shrinks_to_one_symbol_in_few_levels():
    rng = np.random.default_rng(1)
    for s in (rng.integers(0, 1000, 20_000), np.zeros(20_000, np.int64), np.arange(20_000) % 2):
        grammar = periodic_runs.Grammar(np.r_[-1, s, -2])
        assert len(grammar.symbols[-1]) == 1 and len(grammar.symbols) < 120
        assert sum(map(len, grammar.symbols)) < 8 * len(s)


def test_runs_against_plain_ones():
    rng = random.Random(5)
    for _ in range(150):
        documents = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.randint(0, 70), rng.randint(1, 4)
            words = [bytes([97 + rng.randrange(k)]) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            documents.append(words)
        got = [[(s, e - s, q) for s, e, q in r.tolist()] for r in periodic_runs.runs_of(documents)]
        assert got == [brute.runs(w) for w in documents]


def test_runs_of_odd_rows(odd):
    got = listed(periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.looped(odd))))
    want = Counter()
    for doc_id, text, *_ in odd_rows():
        if text is None or len(text) < 10_000:
            want[brute.run_row(doc_id, text)] += 1
        else:  # one word repeated, whatever its tail
            want[(doc_id, 1, 0, 40_000, 1, 40_000_000, brute._sha("0,40000,1\n"), brute._sha("w"))] += 1
    assert got == want


def test_runs_by_other_columns_and_whole_results(spark):
    df = spark.createDataFrame([("k1", "b a b a b a b a c"), ("k2", None)], "key STRING, body STRING")
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(df, "key", "body").collect()}
    assert [tuple(r) for r in rows["k1"].runs] == [(0, 8, 2)] and rows["k1"].collapsed == "b a c"
    assert rows["k2"].runs == [] and rows["k2"].greatest is None and rows["k2"].collapsed == ""


# --- mixing ---


def by_source(rows):
    total = defaultdict(lambda: [0, 0.0, 0, 0])
    for source, row in rows:
        entry = total[source]
        entry[0], entry[1], entry[2], entry[3] = row.source_size, row.target, entry[2] + row.taken, max(entry[3], row.size)
    return total


def test_mix_equals_its_sql(spark, odd):
    frame = odd.select("doc_id", "text", "source").toArrow()
    con = duckdb.connect()
    con.register("documents", frame)
    want = Counter(con.execute(pareto_mix.SQL).fetchall())
    assert listed(pareto_mix.mixed(odd)) == want
    again = odd.repartition(5, "text")
    assert listed(pareto_mix.mixed(again)) == want


def test_taken_words_come_near_the_targets(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * int(rng.paretovariate(1.2) * 20)), None, rng.choice(["big"] * 6 + ["mid"] * 3 + ["few", None]), 0) for k in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in pareto_mix.mixed(docs).collect()}
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in got.values())
    totals = by_source((row[3], got[row[0]]) for row in rows)
    whole = sum(t[0] for t in totals.values())
    assert abs(sum(t[1] for t in totals.values()) - whole) < 1e-6 * whole
    for size, target, taken, longest in totals.values():
        assert target <= 3 * size and abs(taken - target) <= longest / 2
        assert abs(taken - target) <= 0.01 * target
    assert totals["few"][1] == 3 * totals["few"][0] == totals["few"][2]


def test_a_mix_without_words(spark):
    docs = spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 0)], DOCS)
    assert listed(pareto_mix.mixed(docs)) == Counter({(1, 0, 0, 0.0, 0): 1, (2, 0, 0, 0.0, 0): 1})


def test_the_mix_runs_no_python(spark, odd):
    plan = pareto_mix.mixed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- manifest ---


def test_every_node_has_its_own_place():
    for levels in range(1, 5):
        places = np.concatenate([merkle_manifest.address(d, np.arange(16**d), levels) for d in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle_manifest.nodes_in(levels)))
    # The upper half of four levels comes first, then each lower tree in one piece.
    assert merkle_manifest.address(1, np.array([15]), 4).tolist() == [16]
    assert merkle_manifest.address(2, np.array([0, 1]), 4).tolist() == [17, 34]
    assert merkle_manifest.address(3, np.array([0, 16]), 4).tolist() == [18, 35]


@pytest.mark.parametrize("total", [1, 2, 16, 17, 256, 257, 4096])
def test_blocks_against_plain_trees(total):
    leaves = [bytes([k % 256, k // 256]) * 16 for k in range(total)]
    root, paths = brute._tree([x.hex() for x in leaves])
    levels = merkle_manifest.levels_of(total)
    tree = merkle_manifest.build(leaves, levels)
    assert tree[:32].hex() == root
    for k in {0, total // 2, total - 1}:
        path = list(merkle_manifest.siblings(tree, levels, total, k))
        assert [("".join(b), "".join(a)) for b, a in paths[k]] == [(b.hex(), a.hex()) for b, a in path]
        assert merkle_manifest.unpacked(merkle_manifest.packed(path)) == path
        assert merkle_manifest.folded(leaves[k], path).hex() == root


def plain_manifest(rows):
    return Counter(brute.merkle([(d, s, lang, n, t) for d, t, lang, s, n in rows]))


def test_manifest_of_odd_rows(odd):
    assert listed(merkle_manifest.manifest(odd)) == plain_manifest(odd_rows())


def test_manifest_over_several_rounds(spark, monkeypatch):
    """Blocks of 16 leaves, so that the trees of documents and of sources take several rounds."""
    monkeypatch.setattr(merkle_manifest, "BLOCK_EDGES", 1)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16)
    rows = [(k, f"Text {k}", "en", "hot" if k % 2 else f"s{k % 90}", k) for k in range(700)]
    docs = spark.createDataFrame(rows, DOCS)
    rounds = []
    grow = merkle_manifest.grow
    monkeypatch.setattr(merkle_manifest, "grow", lambda nodes: rounds.append(grow(nodes)) or rounds[-1])
    # Tasks import the module anew, so the driver's one-edge blocks are built by four-level ones.
    monkeypatch.setattr(merkle_manifest, "_build", one_edge(merkle_manifest._build))
    monkeypatch.setattr(merkle_manifest, "_descend", one_edge(merkle_manifest._descend))
    monkeypatch.setattr(merkle_manifest, "_prove", one_edge(merkle_manifest._prove))
    assert listed(merkle_manifest.manifest(docs)) == plain_manifest(rows)
    assert [len(r[0]) for r in rounds] == [3, 2]


def one_edge(step):
    name = step.__name__

    def run(batches):
        from tapewright.llm import merkle_manifest as module

        before = module.BLOCK_EDGES, module.BLOCK
        module.BLOCK_EDGES, module.BLOCK = 1, 16
        try:
            yield from getattr(module, name)(batches)
        finally:
            module.BLOCK_EDGES, module.BLOCK = before

    return run


# --- shared ---


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).selectExpr("id", "hash(id) AS value").repartition(7)
    rows = positions.numbered(df, [df["value"], df["id"]], "numbers").collect()
    assert [r.id for r in sorted(rows, key=lambda r: r["rank"])] == [r.id for r in sorted(rows, key=lambda r: (r.value, r.id))]
    assert sorted(r["rank"] for r in rows) == list(range(5000))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for frame in (periodic_runs.periodic_runs(docs), periodic_runs.looped(docs), pareto_mix.mixed(docs), merkle_manifest.manifest(docs)):
        assert frame.collect() == []
