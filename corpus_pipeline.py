"""From raw documents to training tokens: five stages, each a table of what it keeps.

Every stage reads the documents that the stage before it kept and returns documents again;
the last returns tokens. ``run`` writes each result to the shared folder and reads it back,
so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import bpe_stream, leak_search, pairwise_quality, pii_votes, trie_join
from tapewright.llm.columns import bounded_batches
from tapewright.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Ids that may be broadcast instead of shuffling the documents to them.
BROADCAST_IDS = 2_000_000

#: Near duplicates: five-word sequences, similarity of 0.8.
SHINGLE_WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose score, learnt from preference pairs, is below the border. The labels
    are those of the documents at hand."""
    labels = bounded_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    scored = pairwise_quality.scored(docs.select(*COLUMNS), pairwise_quality.learn(docs, labels), "__score")
    return scored.filter(F.col("__score") >= pairwise_quality.BORDER).select(*COLUMNS)


def _ids(rows: DataFrame) -> DataFrame:
    """A written table of ids, broadcast if there are few of them, else shuffled."""
    ids = materialize(rows, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of similar texts, and of rows that
    repeat an id the one with the least text. Documents without words or id are linked with
    nothing and stay."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    groups = materialize(trie_join.similar_groups(docs, SHINGLE_WORDS, PERCENT), "groups")
    kept = docs.join(_ids(groups.filter("doc_id <> component_id").select("doc_id").distinct()), "doc_id", "left_anti")
    repeated = _ids(groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    first = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row"))
    return kept.join(repeated, "doc_id", "left_anti").select(*COLUMNS).unionByName(first.select("doc_id", "row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    items = bounded_batches(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = _ids(leak_search.leaks(docs, items).select("doc_id").distinct())
    return docs.select(*COLUMNS).join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the names of its kinds; every document stays."""
    found = pii_votes.private_spans(docs.select(*COLUMNS))
    text = pii_votes.masked(F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("spans"))
    found = found.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document (little-endian unsigned 32-bit integers) and their number."""
    bounded_batches(spark)
    coded = bpe_stream.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=250_000)
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("decoded", "text"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", *digests)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", without_private_data),
    ("BPE encoding and decoding", tokens),
]

#: A fitted classifier, a trie join and an encoder have no SQL; the tests hold the pipeline
#: against plain Python versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
