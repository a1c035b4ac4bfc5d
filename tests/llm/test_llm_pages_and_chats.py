"""Main text of pages, and conversation snapshots."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tapewright.llm import site_templates, snapshots


def text(source):
    return "\n".join(site_templates.blocks(site_templates.parse(source), frozenset()))


def test_blocks():
    page = (
        "<html><head><title>t</title></head><body><header>Top</header><nav>x</nav><article><h1>T &amp; x</h1><p>a<br>b <b>c</b>"
        '<p>d&nbsp; e<div class="ad">no</div><ul><li>1<li>2</ul><form>q</form><article>comment</article></article><footer>f</footer>'
    )
    assert text(page) == "T & x\na b c\nd e\n1\n2"
    assert text("<main><p>x</p></main><p>y</p>") == "x"
    assert text("<div>hello</div><div><a href=x>menu</a> <a>b</a></div><p>1 < 3 & 5") == "hello\n1 < 3 & 5"


def test_broken_markup():
    assert text("") == "" and text("<") == "<" and text("plain") == "plain"
    assert text("<article>x<script>var t='</p>'</article>") == "x"  # an open script takes the rest
    assert text('<p "unclosed>x</p>y') == "x\ny"
    assert text("<div>" * 5000 + "deep") == "deep"
    assert text("<article><p>cut &am") == "cut &am"


def pages_of(spark, rows):
    return {r.page_id: r.text for r in site_templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()}


def test_recurring_subtrees_go(spark):
    box = "<div><p>Join our readers today.</p></div>"
    rows = [(k, f"http://a.example/{k}", f"<body><div><p>Story {k} begins.</p></div>{box}</body>", 0) for k in range(12)]
    rows += [(100, "http://b.example/1", f"<body><p>Elsewhere.</p>{box}</body>", 0)]
    # A sentence that all articles share is theirs; a box inside them that most have is not.
    rows += [(200 + k, f"//c.example/{k}", f"<article><p>Same.</p><p>Part {k}</p><div>Read more</div></article>", 0) for k in range(12)]
    got = pages_of(spark, rows)
    assert all(got[k] == f"Story {k} begins." for k in range(12))
    assert got[100] == "Elsewhere.\nJoin our readers today."
    assert all(got[200 + k] == f"Same.\nPart {k}" for k in range(12))


def test_shared_prose_stays_without_an_article(spark):
    shared = "<h2>Introduction</h2><table><tr><td>Yes</td><td>Cell</td></tr></table><div>Ten of forty pages.</div>"
    rows = [(k, f"http://a.example/{k}", f"<body><p>Story {k}.</p>{shared if k < 10 else ''}</body>", 0) for k in range(40)]
    # Pages that hold nothing but paragraphs count for the share, a heading on every page is no template.
    rows += [(100 + k, f"http://b.example/{k}", f"<h1>Report</h1><p>Part {k}.</p>{'<div>Some.</div>' if k < 10 else ''}", 0) for k in range(40)]
    got = pages_of(spark, rows)
    assert all(got[k] == f"Story {k}.\nIntroduction\nYes\nCell\nTen of forty pages." for k in range(10))
    assert all(got[100 + k] == f"Report\nPart {k}.\nSome." for k in range(10))
    assert got[20] == "Story 20." and got[120] == "Report\nPart 20."


def test_every_top_level_article_stays():
    long = "word " * 100
    assert text(f"<article><p>{long}</p></article><article><p>Short.</p></article>") == f"{long.strip()}\nShort."
    assert text(f"<main>{long}</main><main>Short.</main><article class='ad'>no</article>") == f"{long.strip()}\nShort."


def linked_menu(k):
    """Furniture of a site without articles: its links differ on every page."""
    return f'<div class="x{k}"><div>Filed under <a href="/{k}">topic{k}</a> by <a>author{k * 7}</a> at the desk</div><ul><li>See also <a>s{k}s{k + 1}</a></ul></div>'


def test_furniture_that_differs_only_in_its_links(spark):
    def story(k):
        return f'<div class="s"><p>Story {k} begins <a>here</a>.</p><div>It goes on, part {k * k}, for a good while.</div></div>'

    rows = [(k, f"http://a.example/{k}", f"<body>{linked_menu(k)}{story(k)}</body>", 0) for k in range(15)]
    rows += [(100 + k, f"http://b.example/{k}", f"<body>{linked_menu(k)}{story(k)}</body>", 0) for k in range(3)]
    # Inside an article a quarter of links is prose; a list that is all links goes.
    inside = "<article><p>Part {0}.</p><div>Seen by <a>friends{0}</a> of the house</div><ul class='more'><li><a>next{0}</a><li><a>last{0}</a></ul></article>"
    rows += [(200 + k, f"http://c.example/{k}", inside.format(k), 0) for k in range(15)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in site_templates.main_text(frame).collect()}
    off = {r.page_id: r.text for r in site_templates.main_text(frame, min_pages=1000).collect()}
    for k in range(15):
        assert got[k] == f"Story {k} begins here.\nIt goes on, part {k * k}, for a good while."
        assert off[k].startswith(f"Filed under topic{k} by author{k * 7} at the desk\nSee also s{k}s{k + 1}\n") and off[k].endswith(got[k])
        assert got[200 + k] == f"Part {k}.\nSeen by friends{k} of the house"
    # Three pages are no evidence.
    assert all(got[100 + k] == off[100 + k] for k in range(3))


def test_words_in_classes_of_an_article():
    assert text('<article><p>a</p><div class="legal side-effects related">b</div><section class="menu">c</section><header>d</header></article>') == "a\nb\nc\nd"
    assert text('<article><p>a</p><div class="box ad">b</div><div class="comments">c</div><nav>d</nav></article>') == "a"
    assert text('<div><p>a</p></div><div class="side-menu">b</div>') == "a"


def brute_templates(rows, min_pages, share):
    """Hosts' templates by plain sets over all subtrees."""
    from collections import defaultdict

    pages, seen = defaultdict(set), defaultdict(lambda: defaultdict(lambda: (0, 0)))
    for _, url, source, _ in rows:
        nodes = site_templates.parse(source or "")
        site = site_templates.host(url)
        main = b"".join(n.digest for n in site_templates.scope(nodes))
        pages[site].add(main)
        kept = {at for at, _ in site_templates.marked(nodes)}
        for c in site_templates.candidates(nodes, list(kept)):
            assert any(c.at <= at <= c.last for at in kept)
            at = seen[site, c.tree, c.inner, c.masked]
            at[main] = tuple(map(max, at[main], (c.linked, c.size)))
    out = set()
    for key, mains in seen.items():
        linked, size = (sum(v[k] for v in mains.values()) for k in (0, 1))
        if len(mains) >= min_pages and len(mains) >= share * len(pages[key[0]]):
            if not key[3] or linked >= site_templates.LINKED[key[2]] * size:
                out.add(key)
    return out


def test_templates_against_plain_counts(spark):
    rng = random.Random(5)
    parts = ["<div>Box <b>one</b></div>", "<ul><li>x<li><a>y</a></ul>", "<section><div>Deep</div><div>Box</div></section>", "<p>Same.</p>"]
    rows = []
    for k in range(160):
        body = "".join(rng.choice(parts) if rng.random() < 0.7 else f"<div class='c{k}'>n <a>{rng.random()}</a></div>" for _ in range(rng.randrange(5)))
        body = f"<article>{body}</article>" if rng.random() < 0.2 else body
        rows.append((k, rng.choice(["http://a/1", "http://b/2", None, "x"]), rng.choice([body, body, None]), 0))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    trees = site_templates.parsed(site_templates._keyed(frame, "page_id", "url", "html"))
    for min_pages, share in ((1, 0.0), (3, 0.1), (10, 0.3)):
        found = {tuple(r) for r in site_templates.templates(trees, min_pages, share).collect()}
        assert found == brute_templates(rows, min_pages, share)
    # The text is that of a second parse with the subtrees deleted one by one.
    gone = brute_templates(rows, 3, 0.1)
    want = {}
    for k, url, source, _ in rows:
        nodes = site_templates.parse(source or "")
        places = site_templates.candidates(nodes, [at for at, _ in site_templates.marked(nodes)])
        deleted = frozenset(c.at for c in places if (site_templates.host(url), c.tree, c.inner, c.masked) in gone)
        want[k] = "\n".join(site_templates.blocks(nodes, deleted))
    assert {r.page_id: r.text for r in site_templates.main_text(frame, min_pages=3, share=0.1).collect()} == want


def test_long_page(spark):
    source = "<div>" + "<p>word &amp; <a>link</a></p>" * 60_000 + "</div>" + "<section>" * 3000 + "deep"
    got = pages_of(spark, [(1, "http://a/", source, 0)])
    assert got[1] == "\n".join(["word & link"] * 60_000 + ["deep"])


def test_page_edges(spark):
    page = "<p>x</p>"
    rows = [(1, None, page, 0), (2, "http://h/", None, 0), (3, "no host", "", 0), (None, "http://h/", page, 0), (4, "http://h/", page, 0), (4, "http://h/", page, 0)]
    found = site_templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, row int")).collect()
    assert sorted(((r.page_id, r.text) for r in found), key=str) == [(1, "x"), (2, ""), (3, ""), (4, "x"), (4, "x"), (None, "x")]
    # Copies of one page are one page: nothing recurs.
    copies = [(k, "http://h/", "<div><p>x</p></div>", 0) for k in range(30)]
    assert set(pages_of(spark, copies).values()) == {"x"}
    assert site_templates.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def collapsed(spark, rows):
    found = snapshots.collapse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, hash int")).collect()
    return {r.conv_id: (r.n_turns, r.n_equal, r.rendered) for r in found}


def test_snapshots_collapse(spark):
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "bye")]
    rows = [(c, k, *t, 0) for c, n in ((1, 1), (2, 2), (3, 3), (4, 3)) for k, t in enumerate(turns[:n])]
    rows += [(5, 0, "user", "hi", 0), (5, 1, "assistant", "other", 0)]
    got = collapsed(spark, rows)
    assert set(got) == {3, 5} and got[3][:2] == (3, 2)
    assert got[5][2] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"


def test_snapshot_edges(spark):
    rows = [(None, 0, "user", "x", 0), (1, None, "user", None, 0), (1, 0, None, "b", 0), (1, 0, None, "b", 0), (2, 0, "user", "z" * 100_000, 0)]
    got = collapsed(spark, rows)
    assert set(got) == {1, 2} and got[1][0] == 2  # NULL turn first, the repeated row once
    assert got[1][2] == "<|im_start|>user\n<|im_end|>\n<|im_start|>\nb<|im_end|>\n"
    # Role and text do not run into each other.
    assert set(collapsed(spark, [(1, 0, "a", "bc", 0), (2, 0, "ab", "c", 0), (2, 1, "x", "", 0)])) == {1, 2}
    assert collapsed(spark, []) == {}


def test_repeated_turns_are_dropped_before_they_are_collected(spark):
    rows = [(1, k % 3, "user", f"t{k % 3}") for k in range(3000)] + [(2, None, None, None), (2, None, "", "")]
    convs = snapshots.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id: [t.text for t in r.turns] for r in convs.collect()} == {1: ["t0", "t1", "t2"], 2: [""]}
    plan = convs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    collects = [k for k, line in enumerate(plan) if "collect_list" in line]
    assert collects and any("Aggregate [conv_id" in line and ", t" in line for line in plan[collects[-1] + 1 :])


def test_prefix_hashes_of_long_conversations(spark):
    """Blocks give the hashes that rolling over all turns gives; thousands of turns take seconds."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = [(c, k, "user", f"turn {k}") for c, n in ((1, 1), (2, snapshots.BLOCK), (3, snapshots.BLOCK + 1), (4, 5000)) for k in range(n)]
    convs = snapshots.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for conv_id, size, hashes in convs.select("conv_id", F.size("turns"), snapshots.prefixes(F.col("turns"))).collect():
        last, want = "", []
        for k in range(size):
            last = sha(last + sha(f"user\0turn {k}"))
            want.append(last)
        assert hashes == want, conv_id
