"""Several queries in one session, and their progress as a table."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Name of the count of rows that reach a sink.
WRITTEN = "written"

PROGRESS = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, output_rows BIGINT, duration_ms BIGINT, "
    "dropped_late BIGINT, state_rows BIGINT, watermark STRING"
)


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait until every query has ended; the first failure stops the rest and is raised."""
    running = list(queries)
    try:
        for query in running:
            query.awaitTermination()
    except Exception:
        stop_all(running)
        raise


def supervise(spark: SparkSession, queries: list[StreamingQuery], poll_seconds: float = 10.0) -> None:
    """Wait for long-running queries; one that fails stops all and raises its error."""
    while any(q.isActive for q in queries):
        spark.streams.resetTerminated()
        if any(q.exception() for q in queries):
            break
        spark.streams.awaitAnyTermination(poll_seconds)
    failed = [q.exception() for q in queries if q.exception()]
    stop_all(queries)
    if failed:
        raise failed[0]


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def counted(stream: DataFrame) -> DataFrame:
    """A stream whose progress reports the rows that reach its sink."""
    return stream.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))


class ProgressLog(StreamingQueryListener):
    """Progress of every micro-batch of a session's queries: rows, duration, late drops, state.

    A query itself remembers its last hundred batches only. The log gets each batch as it
    ends and, given a ``path``, appends them to a table there, so its memory is bounded.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, flush: int = 1000):
        self.spark, self.path, self.flush = spark, path, flush
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        written = p.observedMetrics.get(WRITTEN)
        self.rows.append(
            (
                p.name,
                p.batchId,
                p.numInputRows,
                written["rows"] if written else max(p.sink.numOutputRows, -1),
                p.batchDuration,
                sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                sum(s.numRowsTotal for s in p.stateOperators),
                p.eventTime.get("watermark"),
            )
        )
        if self.path and len(self.rows) >= self.flush:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def _write(self) -> None:
        rows, self.rows = self.rows, []
        self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def close(self, queries: Iterable[StreamingQuery], seconds: float = 60.0) -> DataFrame:
        """Stop listening once the ends of ``queries`` have been reported; the whole log."""
        awaited, until = {str(q.id) for q in queries}, time.monotonic() + seconds
        while not awaited <= self.ended:
            if time.monotonic() > until:
                raise TimeoutError("the end of a query was not reported")
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        if not self.path:
            return self.spark.createDataFrame(self.rows, PROGRESS)
        self._write()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
