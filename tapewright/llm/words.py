"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

# White space of the word definition, and marks that may count as white space.
SPACE = bytes([0x20, *range(0x09, 0x0E)])
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed with one table of powers; longer texts are cut between words.
SEGMENT = (1 << 20) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every bit depends on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    return _powers(size)


def sums(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash: n + 1 values for n codes."""
    up, _ = powers(len(codes) + 1)
    total = np.empty(len(codes) + 1, np.uint64)
    total[0] = 0
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    return total


def between(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the code ranges [start, end)."""
    _, down = powers(len(total))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an array of strings without NULLs one after the other, and their n + 1 borders."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    borders = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, borders - borders[0]


class Words:
    """Words of an array of texts: byte ``start``, ``end`` and ``hash`` of each, and the
    ``first`` word of every text (n + 1 borders). A-Z count as a-z."""

    def __init__(self, texts: pa.Array, separators: bytes = SPACE) -> None:
        raw, borders = flat(texts)
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        breaks = np.zeros(256, bool)
        breaks[list(separators)] = True
        inside = ~breaks[raw]
        # A word starts inside after a break or a border, and ends before one.
        edge = np.zeros(len(raw) + 1, bool)
        edge[borders] = True
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, borders)
        self.hash = np.empty(len(self.start), np.uint64)
        codes = _letters()
        k = 0
        while k < len(self.start):
            # As many words as fit a segment, one at least.
            stop = max(k + 1, int(np.searchsorted(self.end, self.start[k] + SEGMENT, "right")))
            a, b = self.start[k], self.end[stop - 1]
            total = sums(codes[lower[raw[a:b]]])
            self.hash[k:stop] = between(total, self.start[k:stop] - a, self.end[k:stop] - a)
            k = stop

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word sequences, and the index of the first word of each.

        Sequences do not cross texts. A text with fewer words has none.
        """
        count = len(self.hash)
        if count < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = self.hash[: count - n + 1].copy()
        for k in range(1, n):
            value = mix(value * _BASE + self.hash[k : count - n + 1 + k])
        whole = np.ones(count - n + 1, bool)
        for b in np.unique(self.first[1:-1]):
            whole[max(0, b - n + 1) : b] = False
        at = np.flatnonzero(whole)
        return value[at], at


def sequence(hashes: np.ndarray) -> int:
    """One hash for a sequence of word hashes."""
    return int(sequences(hashes, len(hashes))[0])


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash that ``sequence`` gives of every ``n`` consecutive word hashes."""
    size = max(0, len(hashes) - n + 1)
    value = np.full(size, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            value = mix(value * _BASE + hashes[k : k + size])
    return value
