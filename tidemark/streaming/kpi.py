"""Counts over a stream.

Three ways: counts per micro-batch without any state, summed when read; running
counts kept in the state store; or running counts whose state is given up when a
group has been idle.  The first needs no memory that grows with the number of
groups and is the default choice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.functions.values import named
from tidemark.operators.counting import kpi_count
from tidemark.streaming.queries import start


@dataclass(frozen=True)
class KpiStore:
    """Where the counts of streams are kept: ``path`` in a file ``format``.

    Every query has a folder of its own, named by its checkpoint, so that an
    older query's batches never mix in, and commits a batch after its counts
    are complete; readers see committed batches only.
    """

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def _folders(self, checkpoint: str) -> tuple[str, str]:
        own = f"{zlib.crc32(checkpoint.encode()):08x}"
        return f"{self.path}/counts/query={own}", f"{self.path}/commits/query={own}"

    def save(self, counts: DataFrame, batch_id: int, checkpoint: str) -> None:
        """Replace batch ``batch_id`` of the query; a repeated batch replaces itself."""
        folder, commits = self._folders(checkpoint)
        self._writer(counts).save(f"{folder}/batch_id={batch_id}")
        done = counts.sparkSession.range(batch_id, batch_id + 1, 1, 1)
        if batch_id == 0:
            # A new checkpoint under an old path starts anew: this replaces all earlier commits.
            self._writer(done.withColumn("part", F.lit(0))).partitionBy("part").save(commits)
        else:
            self._writer(done).save(f"{commits}/part={batch_id}")

    def _writer(self, rows: DataFrame) -> DataFrameWriter:
        return rows.write.format(self.format).options(**self.options).mode("overwrite")

    def read(self, spark: SparkSession, schema: T.StructType, checkpoint: str) -> DataFrame:
        """The committed counts of one query: the fields of ``schema``, ``count`` and ``batch_id``."""
        folder, commits = self._folders(checkpoint)
        counted = [T.StructField(name, T.LongType()) for name in ("count", "batch_id")]
        full = T.StructType([*schema.fields, *counted])
        reader = spark.read.format(self.format).options(**self.options)
        done = reader.schema("id bigint, part bigint").load(commits).selectExpr("id AS batch_id").distinct()
        stored = spark.read.format(self.format).options(**self.options).schema(full).load(folder)
        return stored.join(done, "batch_id", "left_semi").select(*[named(n) for n in full.fieldNames()])


def kpi_store(store: str | KpiStore) -> KpiStore:
    return KpiStore(store) if isinstance(store, str) else store


def read_kpi_store(
    spark: SparkSession, store: str | KpiStore, schema: T.StructType, checkpoint: str
) -> DataFrame:
    """The committed counts of the query with ``checkpoint``, see ``KpiStore.read``."""
    return kpi_store(store).read(spark, schema, checkpoint)


def kpi_per_batch(
    df: DataFrame, *fields: str, store: str | KpiStore, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Store the counts of every micro-batch.

    A batch that is repeated after a failure overwrites its own folder, so
    the sums over the store stay right.
    """
    kpi_count(df, *fields)  # checks the fields before anything starts

    def save(batch: DataFrame, batch_id: int) -> None:
        kpi_store(store).save(kpi_count(batch, *fields), batch_id, checkpoint)

    return start(df, checkpoint, each_batch=save, every=every)


def running_kpi(
    df: DataFrame,
    *fields: str,
    store: str | KpiStore,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
) -> StreamingQuery:
    """Keep running counts; each batch stores the groups it changed.

    A group appears again whenever it grows: read the store with
    ``latest_kpi``, where the last count of a group wins.  With ``mode``
    ``complete`` every batch stores all groups.
    """

    def save(changed: DataFrame, batch_id: int) -> None:
        kpi_store(store).save(changed, batch_id, checkpoint)

    return start(kpi_count(df, *fields), checkpoint, each_batch=save, mode=mode, every=every)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_COUNTED = "__counted"
#: The column of a store of expiring counts that says when a count began.
SINCE = "since"


def _partial_counts(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``fields`` and the number of rows counted within each Arrow batch, so a hot group sends few of them."""
    groups = [
        F.to_json(named(f)).alias(f) if isinstance(df.schema[f].dataType, T.VariantType) else named(f)
        for f in fields
    ]
    keys = df.select(*groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(list(fields)).aggregate([([], "count_all")])
            yield from found.rename_columns([*fields, _COUNTED]).to_batches()

    return keys.mapInArrow(count, T.StructType([*keys.schema.fields, T.StructField(_COUNTED, T.LongType())]))


def _processor(fields: tuple[str, ...], idle_ms: int) -> StatefulProcessor:
    """The count of each group with a timer that removes it.

    Defined inside a function, so that it is shipped by value.
    """

    class Expiring(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.held = handle.getValueState("held", "n long, since long, ends long")

        def _row(self, key, n: int, since: int) -> pd.DataFrame:
            return pd.DataFrame({**{f: [k] for f, k in zip(fields, key, strict=True)}, SINCE: [since], "count": [n]})

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            now = timerValues.getCurrentProcessingTimeInMs()
            n, since = 0, now
            if self.held.exists():
                n, since, ends = self.held.get()
                self.handle.deleteTimer(ends)
            n += sum(int(part.iloc[:, -1].sum()) for part in rows)
            self.held.update((n, since, now + idle_ms))
            self.handle.registerTimer(now + idle_ms)
            yield self._row(key, n, since)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # The store has the count already; a later row of the group begins a new one.
            self.held.clear()
            yield from ()

        def close(self) -> None:
            pass

    return Expiring()


def expiring_kpi(
    df: DataFrame,
    *fields: str,
    idle: timedelta,
    store: str | KpiStore,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep running counts of the groups that were seen within ``idle``; the state holds no others.

    Each batch stores the groups it changed, with the time ``since`` the count runs.  A group
    that comes again after it was given up starts a new count, so no row is lost however late it
    is: read the store with ``expiring_totals``.  ``since`` is the time of the batch as its offsets
    recorded it, the same when a batch is repeated.
    """
    kpi_count(df, *fields)  # checks the fields before anything starts
    partial = _partial_counts(df, fields)
    if {SINCE, "count", "batch_id"} & set(fields):
        raise ValueError(f"{SINCE}, count and batch_id are columns of the store; rename the field")
    out = T.StructType(
        [*partial.schema.fields[:-1], T.StructField(SINCE, T.LongType()), T.StructField("count", T.LongType())]
    )
    idle_ms = max(1, round(idle.total_seconds() * 1000))
    counts = partial.groupBy(*[named(f) for f in fields]).transformWithStateInPandas(
        _processor(fields, idle_ms), out, "Update", "ProcessingTime"
    )

    def save(changed: DataFrame, batch_id: int) -> None:
        kpi_store(store).save(changed, batch_id, checkpoint)

    # Timers need this kind of state store, and would run empty batches for ever: they go off with
    # the next data, before which the state does not grow.  A query keeps what it started with.
    conf = df.sparkSession.conf
    settings = {_PROVIDER: _ROCKSDB, _NO_DATA_BATCHES: "false"}
    before = {name: conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            conf.set(name, value)
        return start(counts, checkpoint, each_batch=save, mode="update", every=every)
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def expiring_totals(
    spark: SparkSession, store: str | KpiStore, schema: T.StructType, checkpoint: str
) -> DataFrame:
    """The totals of ``expiring_kpi`` by the fields of ``schema``: the last of each count, summed."""
    full = T.StructType([*schema.fields, T.StructField(SINCE, T.LongType())])
    stored = kpi_store(store).read(spark, full, checkpoint)
    fields = [named(f) for f in schema.fieldNames()]
    # A count only grows.
    last = stored.groupBy(*fields, SINCE).agg(F.max("count").alias("count"))
    return last.groupBy(*fields).agg(F.sum("count").alias("count"))
