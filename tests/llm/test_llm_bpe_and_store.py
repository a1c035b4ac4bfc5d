"""Both tokenizers against the library, and the store's files as bytes."""

from __future__ import annotations

import glob
import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from tapewright.llm import bpe_stream, token_store

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def odd_texts(seed, n=400):
    random.seed(seed)
    parts = ["the", "Cat", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "é", "ΑΣ", "İ", "ß", "’s", "'ll", "12", "½", "<|endoftext|>", "<|startoftext|>", "😀", "\xa0", "\x1c", "\x00", "aaaa", "!?", "한국", "​"]
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(n)] + ["", "a" * 5000, "ab" * 3000, "x y " * 2000]


def test_transducer_equals_library():
    codec, want = bpe_stream.Codec(WORDS), library(WORDS)
    for text in odd_texts(1):
        ids = want.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids, repr(text)
        assert codec.tokens(codec.encode(text)) == want.decode(ids, skip_special_tokens=False)


def test_transducer_keeps_a_bounded_tail():
    merges = bpe_stream.Codec(WORDS).merges
    settled = next(merges.encode("ab" * 100_000))  # the first token comes before the word is read
    assert isinstance(settled, int)
    assert merges.lookahead == max(len(t.removesuffix("</w>")) for t in library(WORDS).get_vocab() if not t.startswith("<|"))


def test_decoder_gives_back_bytes(monkeypatch):
    codec = bpe_stream.Codec(WORDS)
    for block in (bpe_stream.BLOCK, 1, 3):
        monkeypatch.setattr(bpe_stream, "BLOCK", block)
        for text in ["the cat", "é 한국 😀", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", ""]:
            assert "".join(codec.text(codec.encode(text))).replace(" ", "") == text.replace(" ", "")
        cut = codec.merges.vocab["Ã"]  # the first byte of a two-byte character alone
        special = codec.special["<|endoftext|>"]
        assert "".join(codec.text(np.array([cut], "<u4").tobytes())) == "\ufffd"
        assert "".join(codec.text(np.array([cut, special, cut], "<u4").tobytes())) == "\ufffd<|endoftext|>\ufffd"


def test_the_query_path_decodes_by_the_state_machine(spark):
    texts = ["The Cat, sat.", "é 한국 😀 <|endoftext|> x", "", "a" * 9000]
    rows = bpe_stream.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS).collect()
    for row in rows:
        assert row.text.replace(" ", "") == texts[row.doc_id].lower().replace(" ", "")


def test_rows_without_an_id_are_dealt_by_their_text(spark, tmp_path):
    """A third of all rows has no id and another third one id; both are spread over shards."""
    rows = [(None, f"text {k} " * 20) for k in range(300)] + [(7, f"word {k} " * 20) for k in range(300)] + [(None, "same")] * 100 + [(k, "x") for k in range(100, 200)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    token_store.write_tokens(docs, str(tmp_path / "store"), BYTES, 2)
    shards = spark.read.parquet(str(tmp_path / "store/manifest")).collect()
    assert sum(r.n_docs for r in shards) == len(rows) and max(r.n_docs for r in shards) < len(rows) / 4
    got = sorted(((r.start, r.doc_id, r.ids) for r in token_store.read_tokens(spark, str(tmp_path / "store")).collect()))
    assert [d for _, d, _ in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [s for s, _, _ in got] == [sum(len(i) // 4 for _, _, i in got[:k]) for k in range(len(got))]


def test_encode_decode_edges(spark):
    rows = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "the", 0), (3, "the", 0), (3, "the", 0)], "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, len(r.ids) // 4, r.decoded) for r in bpe_stream.encode_decode(rows, WORDS).collect()), key=str)
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "the</w>"), (3, 1, "the</w>"), (None, 1, "the</w>")]
    assert bpe_stream.encode_decode(rows.limit(0), WORDS).collect() == []


def test_chunked_encoder_equals_library(monkeypatch):
    want, texts = library(BYTES), odd_texts(2)
    for limit in (token_store.CHUNKS, 3):
        monkeypatch.setattr(token_store, "CHUNKS", limit)
        encoder = token_store.Encoder(BYTES, 2)
        for at in range(0, len(texts), 50):
            for text, raw in zip(texts[at : at + 50], encoder.encode(texts[at : at + 50])):
                assert np.frombuffer(raw, "<u2").tolist() == want.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_frames_and_seek_table():
    sink = pa.BufferOutputStream()
    writer = token_store.ShardWriter(sink, frame_bytes=100)
    docs = [bytes([k]) * n for k, n in enumerate([0, 30, 250, 99, 1])]
    for d in docs:
        writer.add(d)
    writer.close(pa.table({"doc_id": list(range(5)), "n_tokens": [len(d) for d in docs]}))
    data = sink.getvalue().to_pybytes()
    # Any reader of zstandard sees the raw bytes; both tables are skippable frames.
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(docs)
    reader = token_store.ShardReader(pa.BufferReader(data))
    assert len(reader.frames) == 4
    opened = []
    plain = reader.frame
    reader.frame = lambda k: opened.append(k) or plain(k)
    assert reader.read(280, 379) == docs[3] and set(opened) == {2, 3}  # only its own frames
    damaged = bytearray(data)
    damaged[10] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_store.ShardReader(pa.BufferReader(bytes(damaged))).read(0, 10)


def test_store_round_trip(spark, tmp_path):
    texts = [None, "", "the cat", "the cat"] + odd_texts(3, 40)
    rows = [(k if k else None, t, 1) for k, t in enumerate(texts)] + [(2, "the cat", 1)]
    folder = f"{tmp_path}/store"
    token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5), folder, BYTES, 2)
    got = token_store.read_tokens(spark, folder).collect()
    want = library(BYTES)
    at = 0
    for r, (i, text, _) in zip(sorted(got, key=lambda r: r.start), sorted(rows, key=lambda r: (r[0] or 0, r[1] or ""))):
        ids = want.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (i, at, ids)
        at += len(ids)
    wanted = spark.createDataFrame([(7,), (9,), (9,), (1000,)], "doc_id long")
    some = {r.doc_id: r for r in token_store.read_tokens(spark, folder, wanted=wanted).collect()}
    assert some == {r.doc_id: r for r in got if r.doc_id in (7, 9)}
    assert not glob.glob(f"{folder}/.attempt*")


def test_empty_store(spark, tmp_path):
    token_store.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/none", BYTES, 2)
    assert token_store.read_tokens(spark, f"{tmp_path}/none").collect() == []
