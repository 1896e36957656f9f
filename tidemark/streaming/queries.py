"""Starting, watching and awaiting streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

DELIVERY = "delivery"


def start(
    df: DataFrame,
    checkpoint: str,
    *,
    format: str = "parquet",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    every: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a streaming write.

    The checkpoint is required: it is what makes a restart go on instead of
    starting over.  A folder written by one query belongs to it: readers go by
    the list of files that query committed, and would not see other writers.

    ``every`` is a pause such as ``"10 seconds"``; without it the query works
    off what is there, in bounded batches, and stops.
    """
    if not checkpoint:
        raise ValueError("a streaming write needs a checkpoint folder")
    writer: DataStreamWriter = df.writeStream.outputMode(mode).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    writer = writer.format(format).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path) if path else writer.start()


def run_all(queries: Sequence[StreamingQuery], check_every: float = 1.0) -> None:
    """Wait for all queries; when one fails, stop the others and raise its error."""
    while True:
        active = [q for q in queries if q.isActive]
        failed = next((q for q in queries if not q.isActive and q.exception()), None)
        if failed is not None:
            for query in active:
                query.stop()
            raise failed.exception()
        if not active:
            return
        with suppress(StreamingQueryException):  # found as failed on the next turn
            active[0].awaitTermination(check_every)


def with_delivery(df: DataFrame, failed: Column | None = None, name: str = DELIVERY) -> DataFrame:
    """Count the rows passing through, and those for which ``failed`` holds, per batch."""
    bad = F.lit(False) if failed is None else failed
    return df.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias("failed"),
    )


class DeliveryLog(StreamingQueryListener):
    """Keeps the observed counts of every batch of all queries of a session under ``path``.

    ``spark.streams.addListener(log)`` starts it.  Reports are written in lots of ``lot`` batches
    and when a query ends, so their files stay few; ``read`` gives one row per query and
    batch, the last report of a repeated one.  Counts of a lot that is not written yet are
    lost with the driver; the batches themselves are not.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = DELIVERY, lot: int = 100):
        self.spark, self.path, self.name, self.lot = spark, path, name, lot
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(self.name)
        if observed is None:
            return
        row = (str(progress.id), progress.batchId, observed["messages"], observed["failed"], time.time_ns())
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.lot
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all reports of an ended ``query`` are in; they arrive a little after its end."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self._ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of query {query.id} was reported")
            time.sleep(0.05)

    def flush(self) -> None:
        """Write what is held."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    SCHEMA = "query string, batch_id bigint, messages bigint, failed bigint, reported bigint"

    def read(self) -> DataFrame:
        """``query``, ``batch_id``, ``messages`` and ``failed`` of every batch."""
        self.flush()
        reports = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        last = F.max_by(F.struct("messages", "failed"), "reported").alias("last")
        return reports.groupBy("query", "batch_id").agg(last).select("query", "batch_id", "last.*")


def delivery_counts(query: StreamingQuery, name: str = DELIVERY) -> dict[int, dict[str, int]]:
    """The observed counts of the recent batches of a query, by batch id; ``DeliveryLog`` keeps all."""
    counts = {}
    for progress in query.recentProgress:
        observed = progress.observedMetrics.get(name)
        if observed is not None:
            counts[progress.batchId] = {
                "messages": observed["messages"],
                "failed": observed["failed"],
            }
    return counts
