"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A shard holds the ids of consecutive documents. The ids form one byte string that is cut
into frames of a fixed raw size, each compressed alone. A skippable frame with the
documents' ids and lengths follows, then a skippable frame with the seek table of the
zstandard seekable format: compressed size, raw size and checksum (low half of xxh64) of
every frame, the number of frames, a flag byte and the magic number. Any zstandard tool
can read the file; a reader that wants a few documents reads the two tables and only the
frames that these documents touch, and checks each frame's checksum.

Defined results: a NULL or empty text gives only the end id; rows are ordered by id (NULL
first), rows that repeat an id by a digest of their text; extra columns are ignored. An empty table
gives shards without documents.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapewright.llm.columns import pieces, shuffle_partitions, whole_text

# Spark runs one task for each core; the library's own threads would compete with them.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed values of the seekable format.
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1
DOCUMENTS_MAGIC = 0x184D2A50
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 256 << 10
LEVEL = 3
#: Chunks whose ids each worker keeps. When it is full, others are encoded where they occur;
#: it is emptied when a quarter of all chunks are others.
CHUNKS = 1_500_000
CHUNK_CHARS = 48
#: Chunks that are encoded as one text.
GROUP = 512

MANIFEST = "shard int, path string, width int, n_docs long, n_tokens long"

# The character that stands for a blank in byte-level tokens, and the white
# space of the pre-tokenizer's pattern.
BLANK = "\u0120"
SPACE = " \\t\\n\\r\\x0b\\x0c\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Encoder:
    """The tokenizers library behind a bounded memory of chunks it has encoded.

    The library's pattern never joins a character with white space that follows it, so a
    text may be encoded in units of white space and the characters up to the next one.
    """

    UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
    OTHER = re.compile(f"[{SPACE}]")

    def __init__(self, path: str, end_id: int) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"  # machine integers: little-endian on all that Spark runs on
        self.end = array(self.code, [end_id]).tobytes()
        vocabulary = self.library.get_vocab()
        self.heads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.heads[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.marks = dict(zip(".,;:!?", self._encode(list(".,;:!?"))))
        self.spaced: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _encode(self, units: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.library.encode_batch_fast(units, add_special_tokens=False)]

    def _spaced(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk after a blank, many chunks at a time as one text.

        A blank begins a new piece for the library, and of the tokens of a piece only the
        first can hold it; so the ids of a chunk begin where such a token stands. Where
        the numbers do not agree (a vocabulary without such tokens) chunks go one by one.
        """
        out: list[bytes] = []
        groups = [chunks[k : k + GROUP] for k in range(0, len(chunks), GROUP)]
        whole = self.library.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)
        for group, coded in zip(groups, whole):
            ids = np.array(coded.ids, f"<u{self.width}")
            first = np.flatnonzero(self.heads[ids])
            if len(first) != len(group) or first[0]:
                out += self._encode([" " + c for c in group])
                continue
            raw, at = ids.tobytes(), (first * self.width).tolist()
            out += [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]
        return out

    def learn(self, chunks: set[str]) -> dict[str, bytes | None]:
        """Ids of new chunks that follow one blank, or start with their line feed; kept while
        there is room. None for a chunk with white space elsewhere: its text goes unit by unit.
        """
        known = self.spaced
        # Letters and the mark after them are encoded apart.
        marked = [c for c in chunks if c[-1:] in self.marks and c[:-1].isalpha()]
        stems = {c[:-1] for c in marked}
        # Membership chunk by chunk: a set difference would walk through all that is known.
        apart = set(marked)
        plain = [c for c in chunks | stems if c and c not in known and c not in apart and c != "\n" and not self.OTHER.search(c, c[0] == "\n")]
        lines = [c for c in plain if c[0] == "\n"]
        plain = [c for c in plain if c[0] != "\n"]
        found = dict(zip(lines, self._encode(lines))) | dict(zip(plain, self._spaced(plain)))
        found |= {c: (found.get(c[:-1]) or known[c[:-1]]) + self.marks[c[-1]] for c in marked}
        if len(known) < CHUNKS:
            known |= found
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, ``width`` bytes each."""
        known, rows, new = self.spaced, [], set()
        total = 0
        for text in texts:
            chunks = text.replace("\n", " \n").split(" ")
            ids = list(map(known.get, chunks))
            gaps = [k for k, v in enumerate(ids) if v is None]
            new.update(map(chunks.__getitem__, gaps))
            rows.append((chunks, ids, gaps))
            total += len(chunks)
        found, out = self.learn(new), []
        for text, (chunks, ids, gaps), first in zip(texts, rows, self._encode([chunks[0] for chunks, _, _ in rows])):
            for k in gaps:
                ids[k] = found.get(chunks[k])
            ids[0] = first
            out.append(b"".join(ids) + self.end if None not in ids else self.by_units(text) + self.end)
        if len(known) >= CHUNKS and 4 * len(new) > total:
            known.clear()  # other texts than those that filled it
        return out

    def by_units(self, text: str) -> bytes:
        found = self.UNIT.findall(text)
        if len(self.units) > CHUNKS:
            self.units.clear()
        new = list({u for u in found if u not in self.units})
        fresh = dict(zip(new, self._encode(new)))
        body = b"".join(fresh[u] if u in fresh else self.units[u] for u in found)
        self.units |= {u: ids for u, ids in fresh.items() if len(u) <= CHUNK_CHARS}
        return body


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class ShardWriter:
    """Appends documents to one open shard file; memory is one frame and the tables."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES) -> None:
        self.sink, self.frame_bytes = sink, frame_bytes
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.raw, self.frames, self.docs = bytearray(), [], []

    def add(self, raw: bytes) -> None:
        self.raw += raw
        if len(self.raw) >= self.frame_bytes:
            view = bytes(self.raw)
            full = len(view) // self.frame_bytes * self.frame_bytes
            for at in range(0, full, self.frame_bytes):
                self._frame(view[at : at + self.frame_bytes])
            self.raw = bytearray(view[full:])

    def _frame(self, raw: bytes) -> None:
        packed = self.press.compress(raw)
        self.sink.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self, documents: pa.Table) -> None:
        """``documents``: doc_id and n_tokens in the order in which they were added."""
        if self.raw:
            self._frame(bytes(self.raw))
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, documents.schema) as out:
            out.write_table(documents)
        self.sink.write(skippable(DOCUMENTS_MAGIC, zstandard.compress(buffer.getvalue().to_pybytes())))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.sink.write(skippable(SEEK_TABLE_MAGIC, table + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_FOOTER_MAGIC)))


class ShardReader:
    """Random access to the raw bytes of a shard; only the frames asked for are read."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_FOOTER_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table = size - 9 - 12 * count
        source.seek(table)
        self.frames = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        self.start = np.concatenate([[0], np.cumsum(self.frames[:, 1], dtype=np.int64)])
        source.seek(int(self.at[-1]))
        magic, length = struct.unpack("<II", source.read(8))
        if magic != DOCUMENTS_MAGIC:
            raise ValueError("no table of documents")
        with pa.ipc.open_stream(zstandard.decompress(source.read(length))) as stream:
            self.documents = stream.read_all()
        self.open = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            self.source.seek(int(self.at[k]))
            raw = self.open.decompress(self.source.read(int(self.frames[k, 0])))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self._last = (k, raw)
        return self._last[1]

    def read(self, start: int, stop: int) -> bytes:
        out = []
        k = int(np.searchsorted(self.start, start, "right")) - 1
        while start < stop:
            a = start - int(self.start[k])
            part = self.frame(k)[a : a + stop - start]
            out.append(part)
            start += len(part)
            k += 1
        return b"".join(out)


def _place(docs: DataFrame) -> list[Column]:
    """Where each row of a table of files stands; the same for all rows of other tables."""
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        docs.select(*place)
    except AnalysisException:
        return [F.lit("").alias("file"), F.lit(0).alias("row")]
    return place


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write shards in ascending id order below ``folder``.

    One range shuffle of the texts; each range is one task and one shard, written under a
    name of its own attempt and then moved, so that a lost or repeated task does no harm.
    ``folder`` must be reachable from every executor; it also gets a ``manifest`` table.
    """
    # Rows of one id are told apart by a digest of their text, equal rows by their place in the
    # files, so that neither a NULL nor a much repeated id is one range.
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("file"), F.col("row")]
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"), *_place(docs))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    ordered = rows.repartitionByRange(shuffle_partitions(docs), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, shard = encoder(path, end_id), TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        fs.create_dir(root, recursive=True)
        name = f"{root}/shard-{shard:06d}.tokens.zst"
        attempt = f"{root}/.attempt-{shard}-{uuid.uuid4().hex}"
        ids, lengths = [], []
        gc.disable()  # nothing below makes cycles, and looking for them takes a tenth of the time
        try:
            with fs.open_output_stream(attempt, compression=None) as sink:
                writer = ShardWriter(sink)
                for piece in pieces(batches, limit=4 << 20):
                    for raw in use.encode(piece.column("text").to_pylist()):
                        writer.add(raw)
                        lengths.append(len(raw) // use.width)
                    ids.append(piece.column("doc_id"))
                kept = pa.chunked_array(ids) if ids else pa.nulls(0)
                writer.close(pa.table({"doc_id": kept, "n_tokens": pa.array(lengths, pa.int64())}))
        finally:
            gc.enable()
        fs.move(attempt, name)
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "path": [name],
                "width": pa.array([use.width], pa.int32()),
                "n_docs": pa.array([len(lengths)], pa.int64()),
                "n_tokens": pa.array([sum(lengths)], pa.int64()),
            }
        )

    ordered.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, id_type: str = "bigint", wanted: DataFrame | None = None) -> DataFrame:
    """Documents of a store: ``doc_id``, ``start`` (ids before it), ``ids`` (little-endian u32).

    One task reads one shard, frame after frame. With ``wanted`` (a ``doc_id`` column) only
    shards, and in them only frames, that hold those documents are decompressed.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.withColumn("first", F.coalesce(before, F.lit(0))).filter("n_docs > 0")
    shards = shards.select("path", "width", "first").repartition(shuffle_partitions(manifest))
    out = f"doc_id {id_type}, start long, ids binary"
    fs_of = (lambda: pafs.FileSystem.from_uri(folder)[0]) if "://" in folder or folder.startswith("file:") else pafs.LocalFileSystem
    if wanted is not None:
        index = shards.mapInArrow(_index(fs_of), f"path string, width int, doc_id {id_type}, start long, at long, n long")
        rows = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        return rows.repartition("path").sortWithinPartitions("path", "at").mapInArrow(_some(fs_of), out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = fs_of()
        for batch in batches:
            for path, width, first in zip(*(batch.column(c).to_pylist() for c in ("path", "width", "first"))):
                with fs.open_input_file(path) as source:
                    reader = ShardReader(source)
                    lengths = reader.documents.column("n_tokens").to_numpy()
                    at = np.concatenate([[0], np.cumsum(lengths)])
                    step = 64
                    for a in range(0, len(lengths), step):
                        b = min(a + step, len(lengths))
                        raw = [_wide(reader.read(int(at[k]) * width, int(at[k + 1]) * width), width) for k in range(a, b)]
                        yield pa.RecordBatch.from_arrays(
                            [reader.documents.column("doc_id").slice(a, b - a).combine_chunks(), pa.array(at[a:b] + first, pa.int64()), pa.array(raw, pa.binary())],
                            ["doc_id", "start", "ids"],
                        )

    return shards.mapInArrow(run, out)


def _wide(raw: bytes, width: int) -> bytes:
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def _index(fs_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = fs_of()
        for batch in batches:
            for path, width, first in zip(*(batch.column(c).to_pylist() for c in ("path", "width", "first"))):
                with fs.open_input_file(path) as source:
                    documents = ShardReader(source).documents
                n = documents.column("n_tokens").to_numpy()
                at = np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(n)), pa.array([width] * len(n), pa.int32()), documents.column("doc_id").combine_chunks(), pa.array(at + first), pa.array(at), pa.array(n)],
                    ["path", "width", "doc_id", "start", "at", "n"],
                )

    return run


def _some(fs_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path, source, reader = fs_of(), None, None, None
        for batch in batches:
            raw = []
            for p, width, at, n in zip(*(batch.column(c).to_pylist() for c in ("path", "width", "at", "n"))):
                if p != path:
                    if source:
                        source.close()
                    path, source = p, fs.open_input_file(p)
                    reader = ShardReader(source)
                raw.append(_wide(reader.read(at * width, (at + n) * width), width))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(raw, pa.binary())], ["doc_id", "start", "ids"])
        if source:
            source.close()

    return run


def crc32(store: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the checksum of each document's ids."""
    return store.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def unsigned_crc32(raw: bytes) -> int:
    return zlib.crc32(raw) & 0xFFFFFFFF
