"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on. Times are UTC epoch milliseconds throughout, AQE
#: re-plans joins and splits skewed shuffle partitions, and partition overwrites
#: replace only the partitions a job writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the engine's settings (no web page)."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; the only setting a borrowed session must have."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming queries.

    A stateful query freezes its shuffle partition count in its checkpoint, so the
    count is set here, away from the batch session: one per available core unless
    the caller sizes it for the key space.
    """
    child = spark.newSession()
    for key, value in SETTINGS.items():
        child.conf.set(key, value)
    count = state_partitions or spark.sparkContext.defaultParallelism
    child.conf.set("spark.sql.shuffle.partitions", str(count))
    return child


#: Temporary folder of each local session that names no shared one.
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share the driver's disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and
    survives executor loss, unlike cached blocks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
