"""Main text of web pages by removal of what a site repeats.

Pages are parsed once into trees of block elements; the blocks of text and the hashes of
their subtrees are written out. Every subtree that may be furniture is hashed over its tags,
classes and text, and once more as a skeleton: tags and classes from the page down, text
masked, equal neighbours taken as one. Spark counts, for each host, on how many pages with
different main parts a hash occurs, and the subtrees that recur on a large share of the
host's pages are deleted from the blocks: those with the same text, and those with the same
skeleton if links make up a good part of their text over the whole host, whatever the links
say. Elements whose tag or role says what they are (menus, footers, forms, ...) go in any
case, as do those with a telling class; inside an article only a class that is one of a few
plain words counts. The outermost article or main elements, where the page has any, bound
what is kept, so only subtrees of kept blocks are counted; an article inside an article is a
reader's comment, as the markup standard has it. Paragraphs, headings, cells and the like go
with a subtree around them, never by themselves: a sentence that many pages share is still
theirs.

Text: character references decoded, white space inside a block turned into one blank,
blocks in page order joined by line feeds.

Defined results: a NULL or empty page has no text; pages are told apart by id, address and
source, so rows that repeat give the same text and count once; a page whose address has no
host belongs to the empty host; extra columns are ignored; an empty table gives no rows.
Broken markup never fails: whatever is open at the end is closed there. Subtrees that stand
exactly at a limit are templates. A long page costs time by its length and is held by one task.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import pieces
from tapewright.session import materialize

#: A subtree is a template if it occurs on so many different pages of a host, and on this share
#: of the host's pages too.
MIN_PAGES = 10
SHARE = 0.3
#: Least share of link text, over the host, of a skeleton that is a template: outside an article, and inside one.
LINKED = (1 / 3, 0.8)
#: Size of the table of deletions that may be broadcast instead of shuffling the pages to it.
BROADCAST_BYTES = 48 << 20

# Elements by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
DROPPED = frozenset(
    "head nav footer aside form script style title noscript template iframe svg canvas button select textarea dialog menu "
    "object video audio math noembed noframes xmp datalist".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay sidebar side widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer masthead comment comments disqus reply replies respond share sharing social related recommended "
    "newsletter subscribe subscription signup login search toolbar skip legal copyright".split()
)
#: Classes that say what they are inside an article too.
DROPPED_INSIDE = frozenset("ad ads advert adverts advertisement sponsored sidebar comments newsletter".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li dt dd blockquote pre td th caption figcaption summary address".split())
#: A start tag ends an open element of these kinds, up to the nearest of the barriers.
ENDS = {
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset("tr td th".split()), frozenset({"table"})),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset({"option"}), frozenset({"select"})),
}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[(?P<cdata>.*?)\]\]> | <[!?][^>]*+(?:>|\Z)
    | <(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
    | <(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs2>[^>]*+)(?:>|\Z)
    | (?P<text>[^<]++|<)""",
    re.S | re.X,
)
ATTR = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    """A block element: its place in page order, what is in it, and a digest of the subtree."""

    __slots__ = ("at", "tag", "names", "role", "hidden", "parent", "parts", "linked", "size", "digest", "furniture")

    def __init__(self, at: int, tag: str, attrs: str, parent: Node | None) -> None:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)} if attrs.strip() else {}
        self.at, self.tag, self.parent = at, tag, parent
        self.names = f"{found.get('class', '')} {found.get('id', '')}".lower()
        self.role = found.get("role", "").lower()
        style = found.get("style", "").replace(" ", "").lower()
        self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
        self.parts: list[Node | str] = []
        self.linked = self.size = 0
        self.digest = b""
        self.furniture = False

    def inside(self, *tags: str) -> bool:
        node = self.parent
        while node:
            if node.tag in tags:
                return True
            node = node.parent
        return False

    def named(self) -> bool:
        """Whether tag, role or class says that this is no main text."""
        if self.tag in ("html", "body", "article", "main"):
            return bool(DROPPED_NAMES.intersection(re.split(r"[\s_-]+", self.names))) and self.tag == "article"
        if self.tag in DROPPED or self.hidden or self.role in DROPPED_ROLES:
            return True
        if self.inside("article"):
            return bool(DROPPED_INSIDE.intersection(self.names.split()))
        if self.tag == "header":
            return True
        return bool(self.names.strip()) and bool(DROPPED_NAMES.intersection(re.split(r"[\s_-]+", self.names)))


def parse(source: str) -> list[Node]:
    """Block elements in page order; the first is the page. Text that is no markup stays in
    its element as strings, with blanks for line breaks."""
    nodes = [Node(0, "page", "", None)]
    open_, links, skip = nodes[0], 0, None

    def close(upto: Node) -> None:
        nonlocal open_
        while True:
            done = open_
            open_ = done.parent
            finish(done)
            if done is upto:
                return

    for m in TOKEN.finditer(source):
        text = m["text"] or m["cdata"]
        if skip:
            if (m["tag"] or m["tag2"] or "").lower() != skip or not (m["end"] or m["end2"]):
                continue
            skip = None
        if text is not None:
            text = html.unescape(text)
            open_.parts.append(text)
            size = len(text) - text.count(" ")
            open_.size += size
            open_.linked += size if links else 0
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag == "a":
                links = max(0, links - 1)
            node = open_
            while node and node.tag != tag:
                node = node.parent
            if node and node.parent:
                close(node)
        elif tag in INLINE:
            links += tag == "a"
        elif tag in VOID:
            open_.parts.append(" ")
        else:
            if tag in ENDS or (open_.tag == "p" and tag not in RAW):
                ends, barriers = ENDS.get(tag, (frozenset(), frozenset()))
                node = open_
                while node and node.tag not in barriers and node.tag not in ends and node.tag != "p":
                    node = node.parent
                if node and node.parent and node.tag not in barriers:
                    close(node)
            attrs = m["attrs"] or m["attrs2"] or ""
            node = Node(len(nodes), tag, attrs, open_)
            nodes.append(node)
            open_.parts.append(node)
            if attrs.endswith("/") and tag not in RAW:
                finish(node)
            else:
                open_ = node
                links = 0 if tag in ("article", "main", "body") else links
                skip = tag if tag in RAW else None
    close(nodes[0])
    return nodes


def finish(node: Node) -> None:
    """Digest of the subtree, and its text added up in the parent."""
    seen = hashlib.blake2b(f"{node.tag}|{node.names}|{node.role}".encode("utf-8", "replace"), digest_size=8)
    for part in node.parts:
        seen.update(part.digest if isinstance(part, Node) else " ".join(part.split()).encode("utf-8", "replace"))
    node.digest = seen.digest()
    node.furniture = node.named()
    if node.parent:
        node.parent.size += node.size
        node.parent.linked += node.linked


def scope(nodes: list[Node]) -> list[Node]:
    """The elements that hold the main text: articles, else main elements, else the page."""
    gone = [False] * len(nodes)
    for n in nodes[1:]:
        gone[n.at] = n.furniture or gone[n.parent.at]
    for tag in ("article", "main"):
        found = [n for n in nodes if n.tag == tag and not gone[n.at] and not n.inside(tag)]
        if found:
            return found
    return nodes[:1]


def marked(nodes: list[Node]) -> list[tuple[int, str]]:
    """Main text block by block, each with the place of the element whose text it is."""
    out: list[tuple[int, str]] = []
    line: list[str] = []

    def flush(owner: Node) -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append((owner.at, text))

    def walk(root: Node, bounded: bool) -> None:
        stack = [(root, iter(root.parts))]
        while stack:
            node, parts = stack[-1]
            part = next(parts, None)
            if part is None:
                flush(node)
                stack.pop()
            elif isinstance(part, str):
                line.append(part)
            else:
                flush(node)
                if not dropped(part, bounded):
                    stack.append((part, iter(part.parts)))

    def dropped(n: Node, bounded: bool) -> bool:
        if n.furniture or (n.tag == "article" and bounded):
            return True
        # Outside an article, a block that is mostly links is a menu.
        return not bounded and n.tag not in ("html", "body", "article", "main") and 2 * n.linked > n.size > 0

    for root in scope(nodes):
        walk(root, root.tag in ("article", "main"))
    return out


def blocks(nodes: list[Node], deleted: frozenset[int]) -> list[str]:
    """Main text block by block, without the subtrees that start at the places ``deleted``."""
    gone = [n.at in deleted for n in nodes]
    for n in nodes[1:]:
        gone[n.at] |= gone[n.parent.at]
    return [text for at, text in marked(nodes) if not gone[at]]


class Candidate(NamedTuple):
    """A subtree that may be a template: its first and last element, hash, and text in and out of links."""

    at: int
    last: int
    tree: int
    inner: bool
    masked: bool
    linked: int
    size: int


def candidates(nodes: list[Node], owners: list[int]) -> list[Candidate]:
    """Subtrees of kept blocks that may be templates, by their text and, with links, by their skeleton."""
    last, holds, inner = list(range(len(nodes))), [False] * len(nodes), [False] * len(nodes)
    for n in reversed(nodes[1:]):
        up = n.parent.at
        last[up] = max(last[up], last[n.at])
        holds[up] |= holds[n.at] or n.tag in ("article", "main")
    for n in nodes[1:]:
        inner[n.at] = inner[n.parent.at] or n.parent.tag in ("article", "main")
    owners = sorted(owners)
    found = [
        n
        for n in nodes[1:]
        if n.size and n.tag not in PROSE and n.tag not in ("html", "head", "body", "article", "main") and not holds[n.at]
        if bisect_left(owners, n.at) < bisect_right(owners, last[n.at])
    ]
    out = [Candidate(n.at, last[n.at], _signed(n.digest), inner[n.at], False, n.linked, n.size) for n in found]
    if any(n.linked for n in found):
        shapes = skeletons(nodes)
        out += [Candidate(n.at, last[n.at], shapes[n.at], inner[n.at], True, n.linked, n.size) for n in found]
    return out


def skeletons(nodes: list[Node]) -> list[int]:
    """Hashes of subtrees without their text: names from the page down, then what is below, equal
    neighbours once."""
    below: list[list[int]] = [[] for _ in nodes]
    for n in reversed(nodes):
        shape = xxhash.xxh64_intdigest(f"{_plain(n)}|{below[n.at]}")
        if n.parent and below[n.parent.at][-1:] != [shape]:
            below[n.parent.at].append(shape)
    path = [0] * len(nodes)
    for n in nodes[1:]:
        path[n.at] = xxhash.xxh64_intdigest(f"{path[n.parent.at]}|{_plain(n)}")
    return [_signed(xxhash.xxh64_digest(f"{path[n.at]}|{below[n.at]}")) for n in nodes]


def _plain(n: Node) -> str:
    # Numbers in classes and ids often count pages.
    return re.sub("[0-9]+", "0", f"{n.tag}|{n.names}|{n.role}")


def _signed(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")
    )
    return rows.withColumn("row", F.xxhash64("page_id", "url", "html"))


TREE = "struct<at: int, last: int, tree: long, inner: boolean, masked: boolean, linked: long, size: long>"
PARSED = f"row long, host string, main long, owners array<int>, texts array<string>, trees array<{TREE}>"


def parsed(rows: DataFrame) -> DataFrame:
    """One row for each page: its host, a hash of its main part that tells different pages apart,
    its blocks with their elements, and the subtrees that may be templates."""
    fields = zip(Candidate._fields, (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.struct(list(fields))))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            out: list[tuple] = []
            for row, url, source in zip(*(piece.column(c).to_pylist() for c in ("row", "url", "html"))):
                nodes = parse(source)
                lines = marked(nodes)
                main = _signed(hashlib.blake2b(b"".join(n.digest for n in scope(nodes)), digest_size=8).digest())
                owners = [at for at, _ in lines]
                out.append((row, host(url), main, owners, [t for _, t in lines], [c._asdict() for c in candidates(nodes, owners)]))
            columns = list(zip(*out)) or [()] * len(kinds)
            arrays = [piece.column("page_id"), piece.column("url"), *(pa.array(v, k) for v, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "row", "host", "main", "owners", "texts", "trees"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, {PARSED}")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, linked: tuple[float, float] = LINKED) -> DataFrame:
    """Subtrees (``host``, ``tree``, ``inner``, ``masked``) that recur on a large share of the pages of their host."""
    # Each page counts once for a subtree; both steps add up before they shuffle.
    key = ["host", "tree", "inner", "masked"]
    found = pages.select("host", "main", F.inline("trees"))
    each = found.groupBy(*key, "main").agg(F.max("linked").alias("linked"), F.max("size").alias("size"))
    counts = each.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum("linked").alias("linked"), F.sum("size").alias("size"))
    enough = F.when(F.col("inner"), F.lit(linked[1])).otherwise(F.lit(linked[0]))
    counts = counts.filter((F.col("n") >= min_pages) & (~F.col("masked") | (F.col("linked") >= enough * F.col("size"))))
    sizes = pages.groupBy("host", "main").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("pages"))
    return counts.join(sizes, "host").filter(F.col("n") >= share * F.col("pages")).select(*key)


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    share: float = SHARE,
) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page."""
    trees = materialize(parsed(_keyed(pages, id_col, url_col, html_col)), "parsed")
    found = templates(trees, min_pages, share)
    # One template may stand on a third of all pages: the unique side is joined to the split one.
    each = trees.select("row", "host", F.inline("trees")).join(found, ["host", "tree", "inner", "masked"], "left_semi")
    gone = materialize(each.groupBy("row").agg(F.collect_set(F.struct("at", "last")).alias("deleted")), "deleted")
    size = gone.agg(F.sum(F.lit(64) + 8 * F.size("deleted"))).first()[0] or 0
    blocks_of = trees.select("row", "page_id", "url", "owners", "texts")
    joined = blocks_of.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, "row", "left")
    covered = lambda at: F.exists("deleted", lambda d: (d["at"] <= at) & (at <= d["last"]))
    left = F.filter("texts", lambda _, i: ~covered(F.get(F.col("owners"), i)))
    text = F.array_join(F.when(F.col("deleted").isNull(), F.col("texts")).otherwise(left), "\n")
    return joined.select("page_id", "url", text.alias("text"))
