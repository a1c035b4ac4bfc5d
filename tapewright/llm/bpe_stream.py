"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoder.

A merge list encodes a word by applying its merges in order of rank. The same result can
be had from left to right: the encoding of a prefix ends in exactly one token, and a
token may follow another only if encoding the two together gives those two back. So the
last token of every prefix follows from the last tokens of the prefixes at most one
longest token back. That length is the *sufficient lookahead* of the merge list: the
paths from all prefixes that a later token can still attach to meet in one prefix, and
the tokens before it can no longer change. They are emitted, and only the undecided tail
is kept, however long the word is.

Defined results: a NULL or empty text has no tokens; repeated rows are encoded alike;
a NULL id is carried along; columns other than id and text are ignored.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tapewright.llm.columns import pieces, texts

ENCODED = "doc_id {id}, ids binary, decoded string, text string"

#: Chunks, words and pairs of tokens that each worker remembers; each memory is emptied when full.
CHUNKS = 400_000
#: Longest chunk or word that is remembered.
CHUNK_CHARS = 48
#: Ids that the decoder takes in at once.
BLOCK = 4096


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    table = {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Merges:
    """A vocabulary with its merge list."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = "") -> None:
        self.vocab, self.suffix = vocab, suffix
        self.rank = {tuple(m): k for k, m in enumerate(merges)}
        self.token = {i: t for t, i in vocab.items()}
        self.lookahead = max(len(t) - len(suffix) if suffix and t.endswith(suffix) else len(t) for t in vocab)
        #: By pair of ids: the rank of their merge. By id: the merge that makes the token.
        self.joined = {vocab[a] << 32 | vocab[b]: k for (a, b), k in self.rank.items()}
        self.made = {vocab[a + b]: (k, vocab[a], vocab[b]) for (a, b), k in self.rank.items()}
        #: By the last three symbols: how long a token that ends in them can be.
        self.longest: dict[str, int] = {}
        for t in vocab:
            symbols = self.symbols(t)
            end = "".join(symbols[-3:])
            self.longest[end] = max(self.longest.get(end, 0), len(symbols))
        self._pairs: dict[int, bool] = {}
        # Only tokens that are the encoding of their own symbols can occur.
        self.vocab = {t: i for t, i in vocab.items() if self.merged(self.symbols(t)) == [t]}

    def symbols(self, token: str) -> list[str]:
        """The single-character symbols a token is made of; the last carries the suffix."""
        if self.suffix and token.endswith(self.suffix):
            body = list(token[: -len(self.suffix)])
            body[-1] += self.suffix
            return body
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Apply the merges by rank, leftmost first. Only for the symbols of one token."""
        rank, parts = self.rank, list(symbols)
        while len(parts) > 1:
            best, at = min((rank.get(pair, len(rank)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if best == len(rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether encoding the symbols of both tokens gives exactly these two.

        Undoes the merges next to the border from the latest to the earliest. The border
        falls if the two tokens beside it merge before the one that was undone last was
        made; of equal merges the left one comes first.
        """
        joined, made = self.joined, self.made
        limit = len(joined)
        while True:
            if joined.get(left << 32 | right, limit) < limit:
                return False
            a, b = made.get(left), made.get(right)
            if a and (not b or a[0] > b[0]):
                limit, left = a[0], a[2]
            elif b:
                limit, right = b[0] + 1, b[1]
            else:
                return True

    def encode(self, body: str) -> Iterator[int]:
        """Token ids of one word, given as byte symbols, each as soon as it is settled."""
        vocab, suffix, longest, pairs = self.vocab, self.suffix, self.longest, self._pairs
        reach, end = self.lookahead, len(body)
        base, last, before = 0, [-1], [0]  # of the prefix of base + k symbols
        for stop in range(1, end + 1):
            tail = body[max(0, stop - 3) : stop] + (suffix if stop == end else "")
            for start in range(max(base, stop - longest.get(tail, 2)), stop):
                token = vocab.get(body[start:stop] + suffix if stop == end else body[start:stop])
                if token is None:
                    continue
                left = last[start - base]
                if left < 0:
                    break
                pair = left << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= CHUNKS:
                        pairs.clear()
                    fits = pairs[pair] = self.follows(left, token)
                if fits:
                    break
            else:
                raise ValueError(f"no token for {body[stop - 1]!r}")
            last.append(token)
            before.append(start)
            if stop - base >= 4 * reach and stop < end:
                live = set(range(max(base, stop - reach + 1), stop + 1))
                while len(live) > 1:
                    far = max(live)
                    live.remove(far)
                    live.add(before[far - base])
                settled = live.pop()
                if settled > base:
                    yield from self._path(base, settled, last, before)
                    # The prefix at the new base keeps its last token: what follows must fit it.
                    last, before, base = last[settled - base :], before[settled - base :], settled
        yield from self._path(base, end, last, before)

    @staticmethod
    def _path(base: int, stop: int, last: list[int], before: list[int]) -> list[int]:
        out = []
        while stop > base:
            out.append(last[stop - base])
            stop = before[stop - base]
        return out[::-1]


class Codec:
    """Encoder and decoder for a vocabulary file of byte-level words.

    Understands files with the normalizers NFC, white-space replacement and lower case, a
    pattern whose matches are the words, and byte-level symbols with a word-end suffix.
    """

    def __init__(self, path: str, remembered: int = CHUNKS) -> None:
        self.remembered = remembered
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = {s["type"]: s for s in spec["normalizer"]["normalizers"]}
        if set(steps) != {"NFC", "Replace", "Lowercase"} or steps["Replace"]["pattern"] != {"Regex": r"\s+"}:
            raise ValueError("normalizers of this vocabulary file are not supported")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if not split["invert"] or split["behavior"] != "Removed":
            raise ValueError("pre-tokenizer of this vocabulary file is not supported")
        self.merges = Merges(model["vocab"], map(tuple, model["merges"]), model["end_of_word_suffix"] or "")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.names = [""] * (1 + max([*self.merges.token, *self.special.values()]))
        for token, i in [*model["vocab"].items(), *self.special.items()]:
            self.names[i] = token
        self.symbol = byte_symbols()
        self.raw = self._raw_bytes()
        self.is_special = np.zeros(len(self.names), bool)
        self.is_special[list(self.special.values())] = True
        self.known: dict[str, bytes] = {}
        self.chunks = Chunks(self)

    def _raw_bytes(self) -> list[bytes]:
        """Bytes that each token stands for, with a blank at the end of a word."""
        byte, suffix = {c: b for b, c in enumerate(self.symbol)}, self.merges.suffix
        out = []
        for i, name in enumerate(self.names):
            ended = bool(suffix) and name.endswith(suffix)
            body = name[: -len(suffix)] if ended else name
            out.append(b"" if i in self.special.values() else bytes(byte[c] for c in body) + b" " * ended)
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalized."""
        text = unicodedata.normalize("NFC", text)
        # Lower case goes character by character: a sigma at the end of a word is no exception.
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return self.word.findall(text)

    def ids(self, word: str) -> Iterator[int]:
        """Ids of one word, each as soon as it is settled."""
        return self.merges.encode("".join(map(self.symbol.__getitem__, word.encode("utf-8"))))

    def packed(self, word: str) -> bytes:
        """Ids of one word as bytes; short words are remembered."""
        known = self.known.get(word)
        if known is None:
            known = array("I", self.ids(word)).tobytes()  # little-endian on all that Spark runs on
            if len(word) <= CHUNK_CHARS:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[word] = known
        return known

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers.

        Blanks and line feeds end a word in every case, so the text goes chunk by chunk.
        """
        parts = self.cut.split(text) if "<|" in text else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out += map(self.chunks.__getitem__, part.replace("\n", " ").split(" "))
        return b"".join(out)

    def tokens(self, ids: bytes) -> str:
        """Names of the tokens, set off by blanks (a vocabulary file without decoder)."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def text(self, ids: bytes) -> Iterator[str]:
        """Decoded text of ids, piece by piece, as soon as its bytes are complete.

        The state is the start of an unfinished character (at most three bytes); bytes
        that form no character come out as U+FFFD. Word ends become blanks, and a special
        token ends whatever is unfinished. ``BLOCK`` ids are fed to the state at once.
        """
        state = codecs.getincrementaldecoder("utf-8")("replace")
        every = np.frombuffer(ids, "<u4")
        for at in range(0, len(every), BLOCK):
            part = every[at : at + BLOCK]
            borders = [0, *(np.flatnonzero(self.is_special[part]) + 1).tolist()]
            for a, b in zip(borders, [*borders[1:], len(part) + 1]):
                yield state.decode(b"".join(map(self.raw.__getitem__, part[a : b - 1].tolist())))
                if b <= len(part):
                    yield state.decode(b"", True) + self.names[part[b - 1]]
                    state.reset()
        yield state.decode(b"", True)


class Chunks(dict):
    """Ids of chunks between blanks, computed when first asked for; bounded."""

    def __init__(self, codec: Codec) -> None:
        super().__init__({"": b""})
        self.codec = codec

    def __missing__(self, chunk: str) -> bytes:
        ids = b"".join(map(self.codec.packed, self.codec.words(chunk)))
        if len(chunk) <= CHUNK_CHARS:
            if len(self) >= self.codec.remembered:
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def codec(path: str, remembered: int = CHUNKS) -> Codec:
    """One codec for each vocabulary file and worker."""
    return Codec(path, remembered)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = CHUNKS) -> DataFrame:
    """Encode every whole text and decode it again; ``remembered`` chunks and words stay in each
    worker's memory (about 350 bytes for each).

    Returns ``doc_id``, ``ids`` (little-endian unsigned 32-bit integers), ``decoded``
    (the names of the tokens set off by blanks, read back from ``ids``, as a file without a
    decoder has it) and ``text`` (what the bytes of the tokens spell, by the state machine).
    No shuffle; a task holds a few MB of text at a time, or one text.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, remembered)
        for piece in pieces(batches):
            ids = [use.encode(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(ids, pa.binary()),
                    pa.array(map(use.tokens, ids), pa.string()),
                    pa.array(("".join(use.text(i)) for i in ids), pa.string()),
                ],
                ["doc_id", "ids", "decoded", "text"],
            )

    return rows.mapInArrow(run, ENCODED.format(id=kind))
