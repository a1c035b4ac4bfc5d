"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tapewright.sources.decode import decode_json

#: Options of a broker subscription: start at the newest offset, go on over lost data.
BROKER_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def broker_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``format("kafka")``; the connector jar comes with the cluster."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **BROKER_DEFAULTS}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_broker(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None) -> DataFrame:
    """Raw messages (``value`` holds the JSON) of one topic."""
    return spark.readStream.format("kafka").options(**broker_options(servers, topic, max_per_trigger)).load()


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: T.StructType | str = "value STRING",
    max_files: int | None = None,
) -> DataFrame:
    """A folder as a stream; ``max_files`` limits one micro-batch like the broker ceiling."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def decoded(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed events of a raw message stream."""
    return decode_json(stream, schema)
