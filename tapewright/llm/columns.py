"""Reading the columns an operator needs, and handing texts to Python in bounded pieces."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handed to Python code at once. A single longer text is handed over alone.
PIECE_BYTES = 1 << 20


#: Rows of one Arrow batch. Spark's default of 10 000 may be hundreds of MB of text.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Let the session hand at most ``BATCH_ROWS`` rows to Python at once."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting, "10000")) > BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark


def whole_text(column: str = "text") -> Column:
    """The text, with NULL read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``; whatever other columns are called, they are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds at most ``limit`` bytes or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        first, total = 0, 0
        for row, size in enumerate(sizes):
            if row > first and total + (size or 0) > limit:
                yield batch.slice(first, row - first)
                first, total = row, 0
            total += size or 0
        if first < len(sizes):
            yield batch.slice(first)
    release()


def release() -> None:
    """Give freed memory back to the machine: Spark keeps Python workers between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
