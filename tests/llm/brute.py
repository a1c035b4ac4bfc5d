"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeats(texts: list[str], length: int) -> list[tuple[int, int, int, str]]:
    """Bytes, removed bytes, runs and digest of the rest of every text."""
    raws = [t.encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def shingles(text: str, n: int) -> frozenset:
    words = WORD.findall(text.translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def similar(texts: dict, n: int, percent: int) -> dict:
    """Set size and component of every id."""
    sets = {d: shingles(t, n) for d, t in texts.items()}
    up = {d: d for d in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    held = defaultdict(list)
    for d in sorted(sets):
        count = Counter(o for g in sets[d] for o in held[g])
        for o, both in count.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[o]) - both):
                a, b = root(d), root(o)
                up[max(a, b)] = min(a, b)
        for g in sets[d]:
            held[g].append(d)
    return {d: (len(sets[d]), root(d)) for d in texts}


def rule_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def _luhn(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def _digits(value: str) -> int:
    return sum(c.isdigit() for c in value)


PRIVATE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= _digits(v) <= 19 and _luhn(v)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= _digits(v) <= 15),
}


def private(text: str) -> dict[str, list[tuple[int, int]]]:
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(m.group())] for k, (p, ok) in PRIVATE.items()}


def looped(words: list, doc_id) -> list:
    """The words with their tail made periodic where the id's checksum asks for it."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words: list) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every maximal run of four periods and six words."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            s = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            size = x + q - s
            smaller = any(all(words[k] == words[k + p] for k in range(s, s + size - p)) for p in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, text) -> tuple:
    words = looped([w for w in WORD.findall(text or "")], doc_id)
    found = runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row: tuple) -> str:
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The root over the nodes, and for each node its siblings before and after, upwards."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place // 16 * 16
            paths[k].append((nodes[first:place], nodes[place + 1 : first + 16]))
        nodes = [_sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0], paths


def merkle(rows: list[tuple]) -> list[tuple]:
    """Rows are (doc_id, source, lang, n_chars, text)."""
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        members = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[name] = members, *_tree([_leaf(r) for r in members])
    root, tops = _tree([trees[n][1] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        members, subroot, paths = trees[name]
        for row, own in zip(members, paths, strict=True):
            path = own + top
            node = _leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = _leaf((*row[:4], None if row[4] is None else row[4].translate(LOWER)))
            for before, after in path:
                node = _sha("".join([*before, node, *after]))
            proof = _sha("".join(h for b, a in path for h in [*b, *a]))
            out.append((row[0], _leaf(row), subroot, root, proof, node, node == root))
    return out
