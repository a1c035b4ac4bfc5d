"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import bpe_stream, divergence, leak_search, merkle_manifest, pairwise_quality, pareto_mix, periodic_runs, pii_votes, site_templates, snapshots, suffix_dedup, token_store, trie_join
from tapewright.llm.columns import bounded_batches, texts
from tapewright.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


@query
def op3_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document and their decoding, as digests."""
    coded = bpe_stream.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), remembered=800_000)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@query
def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Write all token ids as seekable frames and read every document back."""
    store = scratch_path(spark, "tokens")
    docs = table(spark, folder, "documents")
    token_store.write_tokens(docs, store, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_store.crc32(token_store.read_tokens(spark, store, docs.schema["doc_id"].dataType.simpleString()))


@query
def op10_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Score every document with weights learnt from the labelled rows of the other folds."""
    docs = table(spark, folder, "documents")
    ranking = pairwise_quality.learn(docs, table(spark, folder, "labels"))
    rows = pairwise_quality.scored(texts(docs), ranking)
    return rows.select(
        "doc_id",
        pairwise_quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= pairwise_quality.BORDER).cast("int").alias("predicted"),
    )


@query
def op4_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and the verdict of the distribution test for every document."""
    rows = materialize(divergence.measured(table(spark, folder, "documents")), "measures")
    return divergence.judged(rows, divergence.references(rows))


@query
def op9_pii_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii_votes.digest(pii_votes.private_spans(texts(table(spark, folder, "documents"))))


@query
def op2_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    rows = site_templates.main_text(table(spark, folder, "pages"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op8_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return snapshots.collapse(table(spark, folder, "conversations"))


oracle("op8_snapshots", snapshots.SQL)


@query
def op7_leak_search(spark: SparkSession, folder: str) -> DataFrame:
    """Training documents that contain a test item, with the item and the overlaps."""
    return leak_search.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_trie_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose four-word sequences are 85 percent alike."""
    return trie_join.similar_groups(table(spark, folder, "documents"), 4, 85)


@query
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of strings that start twice in the corpus."""
    rows = suffix_dedup.without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, and digests of the texts without them."""
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.looped(table(spark, folder, "documents"))))


@query
def op12_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix of sources takes of it."""
    return pareto_mix.mixed(table(spark, folder, "documents"))


oracle("op12_pareto_mix", pareto_mix.SQL)


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document."""
    return merkle_manifest.manifest(table(spark, folder, "documents"))
