"""Distributed, replay-safe writes of Parquet tables."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.operators.serving import latest_per_key
from tapewright.schemas import PARTITION_SPAN, STORED_CANDLE
from tapewright.sources.tables import day_of, partition_date


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch: the query's own id, which a new checkpoint renews, and its number."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}:{batch_id}"


def write_partitions(rows: DataFrame, path: str, partitions: list[str], mode: str = "overwrite") -> None:
    """Replace the partitions ``rows`` fall into, or append to them.

    Rebalancing brings a partition's rows together, so it becomes few files, and splits
    a partition that is too large for one task.
    """
    (
        rows.hint("rebalance", *map(F.col, partitions))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _file(spark: SparkSession, path: str):
    """A path and the file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


#: Files whose changes one round of a compaction folds.
FILES_AT_ONCE = 10_000

#: Columns a stored change has besides the table's: which fields it carries, and when it was
#: written (microseconds).
CHANGE = T.StructType().add("_given", T.ArrayType(T.StringType())).add("_at", T.LongType())


@dataclass
class KeyedTable:
    """A Parquet table with a unique key and newest-wins upserts, stored as changes.

    An upsert appends its rows to the partitions they fall into; nothing stored is read or
    rewritten, so its work follows the batch and not the partition, writers need not know
    of each other, and a writer that is cut off leaves nothing behind. Reading takes, for
    every key and field, the newest change that carries the field: by ``order``, then by
    the time of writing. A replayed batch adds equal changes. Tables with several writers,
    or with late messages, need an ``order``. ``compact`` folds changes together.
    """

    path: str
    schema: T.StructType
    keys: list[str]
    partitions: list[str]
    order: list[str] = field(default_factory=list)

    def changes(self, spark: SparkSession) -> DataFrame:
        """All stored changes."""
        return spark.read.schema(T.StructType([*self.schema.fields, *CHANGE.fields])).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The current rows. Filters on keys and partitions reach the scan."""
        return self._newest(self.changes(spark)).select(*self.schema.fieldNames())

    def prepare(self, rows: DataFrame) -> DataFrame:
        """Hook: derive partition columns."""
        return rows

    def upsert(self, rows: DataFrame) -> None:
        """Insert ``rows`` or replace the fields of the rows with the same key.

        Fields the new rows do not carry keep their stored values.
        """
        unknown = set(rows.columns) - set(self.schema.fieldNames())
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
        fields = [c for c in self.schema.fieldNames() if c in rows.columns and c not in self._group()]
        rows = self.prepare(rows)
        order = [c for c in self.order if c in rows.columns]
        new = latest_per_key(rows, self.keys, order) if order else rows.dropDuplicates(self.keys)
        given = F.array(*map(F.lit, fields)).cast("array<string>").alias("_given")
        write_partitions(new.select("*", given, F.lit(time.time_ns() // 1000).alias("_at")), self.path, self.partitions, "append")

    def _group(self) -> list[str]:
        return [*self.keys, *(c for c in self.partitions if c not in self.keys)]

    def _version(self) -> Column:
        """Order of changes as one value; a single whole-number column and the time of writing
        share a decimal, which aggregates without sorting."""
        at = F.coalesce("_at", F.lit(0).cast("bigint"))
        if len(self.order) == 1:
            first = F.coalesce(self.order[0], F.lit(-1).cast("bigint")).cast("decimal(18,0)")
            return first * F.lit(str(10**19)).cast("decimal(20,0)") + at
        return F.struct(*self.order, at) if self.order else at

    def _newest(self, changes: DataFrame) -> DataFrame:
        changes = changes.withColumn("_version", self._version())
        fields = [c for c in self.schema.fieldNames() if c not in self._group()]
        newest = [
            F.expr(f"max_by(`{c}`, _version) FILTER (WHERE _given IS NULL OR array_contains(_given, '{c}')) AS `{c}`") for c in fields
        ]
        known = F.array_distinct(F.flatten(F.collect_set(F.coalesce("_given", F.array(*map(F.lit, fields)))))).alias("_given")
        return changes.groupBy(*self._group()).agg(*newest, known, F.max("_at").alias("_at"))

    def compact(self, spark: SparkSession, where: Column | None = None) -> int:
        """Fold the changes of the partitions that ``where`` selects; returns the files replaced.

        The folded rows are added first and the files they came from deleted after that:
        a compaction that is cut off leaves changes twice, which read the same, and files
        that other writers add meanwhile stay. ``where`` may name partition columns only.
        Partitions are folded some at a time, so that the driver holds the paths of about
        ``FILES_AT_ONCE`` files, or of one partition that has more.
        """
        changes = self.changes(spark) if where is None else self.changes(spark).where(where)
        files = changes.select(*self.partitions, F.col("_metadata.file_path").alias("_file")).distinct()
        sizes = files.groupBy(*self.partitions).count().orderBy(*self.partitions).collect()
        return sum(self._fold(spark, changes, chosen) for chosen in self._rounds(sizes))

    def _rounds(self, sizes: list[Row]) -> Iterator[Column]:
        """Filters that select partitions of about ``FILES_AT_ONCE`` files together."""
        chosen, files = F.lit(False), 0
        for size in sizes:
            if files and files + size["count"] > FILES_AT_ONCE:
                yield chosen
                chosen, files = F.lit(False), 0
            same = (F.col(c).eqNullSafe(F.lit(size[c])) for c in self.partitions)
            chosen, files = chosen | reduce(and_, same), files + size["count"]
        if files:
            yield chosen

    def _fold(self, spark: SparkSession, changes: DataFrame, chosen: Column) -> int:
        old = [r[0] for r in changes.where(chosen).select("_metadata.file_path").distinct().collect()]
        listed = spark.read.schema(changes.schema).option("basePath", self.path).parquet(*old)
        write_partitions(self._newest(listed), self.path, self.partitions, "append")
        for name in old:
            target, fs = _file(spark, name)
            fs.delete(target, False)
        return len(old)


class CandleTable(KeyedTable):
    """Candles of all intervals, keyed by symbol, interval and open time."""

    def __init__(self, path: str, order: list[str] | None = None):
        super().__init__(path, STORED_CANDLE, ["symbol", "interval", "open_time"], ["interval", "date"], order or [])

    def prepare(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("date", partition_date(F.col("interval"), F.col("open_time")))


def append_once(rows: DataFrame, path: str, column: str, batch: str) -> None:
    """Append one micro-batch to a history with one folder for each day.

    The batch is written aside and its files are then moved into the days under the
    batch's name. A replay first removes what files of that name are there, so a batch
    counts once wherever it was cut off; the number of folders follows the days.
    """
    spark = rows.sparkSession
    name = batch.replace(":", "-")
    aside = f"{path.rstrip('/')}__batches/{name}"
    dated = rows.withColumn("date", day_of(F.col(column)))
    dated.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(aside)
    source, fs = _file(spark, f"{aside}/date=*/*.parquet")
    for stale in fs.globStatus(_file(spark, f"{path}/date=*/{name}.*.parquet")[0]) or []:
        fs.delete(stale.getPath(), False)
    for k, status in enumerate(fs.globStatus(source) or []):
        day = _file(spark, f"{path}/{status.getPath().getParent().getName()}")[0]
        fs.mkdirs(day)
        if not fs.rename(status.getPath(), _file(spark, f"{day}/{name}.{k:05d}.parquet")[0]):
            raise OSError(f"cannot move a file of batch {batch} into {day}")
    fs.delete(_file(spark, aside)[0], True)


def replace_table(rows: DataFrame, path: str) -> None:
    """Write a small latest-value table whole, as a new version that readers switch to at once.

    Readers of ``read_latest`` see the old version until the new one is complete. The two
    newest versions stay, for readers that have just opened one.
    """
    spark = rows.sparkSession
    version = f"v{time.time_ns():020d}"
    rows.write.parquet(f"{path}/{version}")
    done = _versions(spark, path)
    for old in done[:-2]:
        target, fs = _file(spark, f"{path}/{old}")
        fs.delete(target, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first: the writer marks a folder when all of it is there."""
    pattern, fs = _file(spark, f"{path}/v*/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in fs.globStatus(pattern) or [])


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a replaced table."""
    done = _versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(f"{path}/{done[-1]}")


def span_end(day: str, span: str) -> str:
    """First day after the span of a partition that is named by its first day."""
    first = date.fromisoformat(day)
    if span == "year":
        return first.replace(year=first.year + 1).isoformat()
    if span == "month":
        return (first.replace(day=28) + timedelta(days=4)).replace(day=1).isoformat()
    return (first + timedelta(days=1)).isoformat()


def expire_days(spark: SparkSession, path: str, before: str, interval: str | None = None) -> list[str]:
    """Drop ``date=`` partitions all of whose days are older than ``before``; returns their paths.

    Folders are dropped, not rewritten, so the cost does not grow with their rows; the
    partition that holds the border stays, and ``retain`` filters it. For candles, ``path``
    is the folder of one ``interval``, whose partitions may span a month or a year.
    """
    pattern, fs = _file(spark, f"{path}/date=*")
    span = PARTITION_SPAN[interval] if interval else "day"
    dropped = []
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        if span_end(folder.getName().split("=", 1)[1], span) <= before:
            fs.delete(folder, True)
            dropped.append(str(folder))
    return sorted(dropped)
