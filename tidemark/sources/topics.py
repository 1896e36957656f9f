"""Topics as DataFrames, from a broker or from a directory of message files.

Both forms have the same columns.  A directory holds one folder per topic, so
subscribing prunes whole folders.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import decode_text, text_bytes
from tidemark.operators.parsing import apply_schema

ENVELOPE = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("value", T.BinaryType())
    .add("topic", T.StringType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
    .add("timestampType", T.IntegerType())
)
# One read task takes at most this many messages, so that a topic with a single
# partition, or with one that holds most of it, is still read by many tasks.
MESSAGES_PER_TASK = 1_000_000
# Bounds of a micro-batch: messages of a broker, files of a directory.
MESSAGES_PER_BATCH = 100_000_000
FILES_PER_BATCH = 10_000

INTERNAL_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]


@dataclass(frozen=True)
class TopicSource:
    """Which topics to read and where they are.

    ``topics`` lists names, ``pattern`` is a regular expression over names;
    with neither, every topic of a directory is read.  ``format`` is
    ``kafka`` (``options`` then carry ``kafka.bootstrap.servers`` and any
    security settings) or a file format with ``path``.
    """

    topics: tuple[str, ...] = ()
    pattern: str | None = None
    format: str = "kafka"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.topics and self.pattern:
            raise ValueError("give topics or a pattern, not both")
        if self.format == "kafka" and not (self.topics or self.pattern):
            raise ValueError("a broker needs topics or a pattern to subscribe to")
        if self.format != "kafka" and not self.path:
            raise ValueError(f"format {self.format} needs a path")

    def reader_options(
        self, starting: str | None = None, max_per_trigger: int | None = None
    ) -> dict[str, str]:
        """The options of a read; what the caller set in ``options`` wins.

        ``starting`` is given for a stream only.
        """
        if self.format != "kafka":
            bound = {"maxFilesPerTrigger": str(max_per_trigger or FILES_PER_BATCH)}
            return {**(bound if starting else {}), **self.options}
        found = {"maxRecordsPerPartition": str(MESSAGES_PER_TASK)}
        if starting:
            found["startingOffsets"] = starting
            found["maxOffsetsPerTrigger"] = str(max_per_trigger or MESSAGES_PER_BATCH)
        if self.pattern:
            found["subscribePattern"] = self.pattern
        else:
            found["subscribe"] = ",".join(self.topics)
        return {**found, **self.options}

    def only_subscribed(self, messages: DataFrame) -> DataFrame:
        messages = messages.select(*ENVELOPE.names)
        if self.pattern:
            return messages.where(F.col("topic").rlike(f"^(?:{self.pattern})$"))
        if self.topics:
            return messages.where(F.col("topic").isin(*self.topics))
        return messages


def read_topic(spark: SparkSession, source: TopicSource) -> DataFrame:
    """A bounded read of everything retained, from the earliest message on."""
    reader = spark.read.format(source.format).options(**source.reader_options())
    if source.format == "kafka":
        return reader.load()
    return source.only_subscribed(reader.schema(ENVELOPE).load(source.path))


def stream_topic(
    spark: SparkSession,
    source: TopicSource,
    starting: str = "latest",
    state: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """An unbounded read.

    ``starting`` counts for the first start only; afterwards the checkpoint
    of the query says where to go on.  A directory has no built-in notion of
    *latest*: files that arrive after its first start count, whatever their time stamp;
    the list of those that were there is kept under ``state``.
    Micro-batches are bounded, also when a long log is replayed;
    ``max_per_trigger`` changes the bound.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError("starting is 'earliest' or 'latest'")
    reader = spark.readStream.format(source.format).options(
        **source.reader_options(starting, max_per_trigger)
    )
    if source.format == "kafka":
        return reader.load()
    landed = reader.schema(ENVELOPE).load(source.path)
    if starting == "latest":
        if state is None:
            raise ValueError("starting a directory at 'latest' needs a state folder")
        landed = landed.withColumn("__file", F.col("_metadata.file_path"))
        landed = landed.join(_first_files(spark, source, state), "__file", "left_anti")
    return source.only_subscribed(landed)


def _first_files(spark: SparkSession, source: TopicSource, state: str) -> DataFrame:
    """The files that were there at the first start, as ``__file``; the list is kept under ``state``."""
    schema = T.StructType().add("__file", T.StringType())
    try:
        # The list is complete once its commit marker is there; a start that died is made again.
        spark.read.schema("value string").text(f"{state}/_SUCCESS").first()
        kept = spark.read.parquet(state)
        # A position of another form without a row says nothing either.
        complete = "__file" in kept.columns or not kept.isEmpty()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        complete = False
    if not complete:
        files = spark.read.format(source.format).options(**source.reader_options())
        there = files.schema(ENVELOPE).load(source.path).select(F.col("_metadata.file_path").alias("__file"))
        there.distinct().write.mode("overwrite").parquet(state)
    return spark.read.schema(schema).parquet(state)


def append_topic(
    df: DataFrame,
    path: str,
    topic: str | None = None,
    partitions: int = 1,
    format: str = "parquet",
) -> None:
    """Append messages to a topic directory, a landing folder that many readers share.

    ``df`` has ``value`` and optionally ``key``, ``topic``, ``partition``,
    ``offset`` and ``timestamp``.  Positions are the ones the messages bring; a
    directory gives none, so messages without them keep a NULL offset.  Local
    timestamps are taken as UTC, whatever the session zone.
    """
    have = set(df.columns)
    if topic is None and "topic" not in have:
        raise ValueError("name a topic or bring a topic column")
    arrival = F.monotonically_increasing_id()
    offset = F.col("offset") if "offset" in have else F.lit(None)
    taken = F.col("timestamp") if "timestamp" in have else F.current_timestamp()
    if "timestamp" in have and isinstance(df.schema["timestamp"].dataType, T.TimestampNTZType):
        taken = F.concat(taken.cast("string"), F.lit("Z"))
    if "partition" in have:
        partition = F.col("partition").cast("int")
    elif partitions == 1:
        partition = F.lit(0)
    elif "key" in have:
        by_key = F.xxhash64(text_bytes(F.col("key")))
        spread = F.when(F.col("key").isNull(), arrival).otherwise(by_key)
        partition = F.pmod(spread, F.lit(partitions))
    else:
        partition = F.pmod(arrival, F.lit(partitions))
    df.select(
        (text_bytes(F.col("key")) if "key" in have else F.lit(None).cast("binary")).alias("key"),
        text_bytes(F.col("value")).alias("value"),
        (F.lit(topic) if topic is not None else F.col("topic")).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        taken.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).write.format(format).mode("append").partitionBy("topic").save(path)


def utc_time(instant: Column) -> Column:
    """An instant as the local time that clocks showed in UTC, in any session zone."""
    micros = F.unix_micros(instant) * F.expr("INTERVAL '0.000001' SECOND")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + micros


def topic_table(
    messages: DataFrame,
    topic: str,
    schema: T.StructType,
    include_internal: bool = False,
) -> DataFrame:
    """One topic as a table: the typed payload of its JSON objects.

    Partition, offset, timestamp, key and raw value stay hidden unless asked
    for.
    """
    rows = messages.where(F.col("topic") == topic)
    if not include_internal:
        return apply_schema(rows, schema)
    clash = set(INTERNAL_COLUMNS) & set(schema.fieldNames())
    internal = [c for c in INTERNAL_COLUMNS if c in rows.columns]
    renamed = rows.select(
        *[F.col(c).alias(f"_{c}") if c in clash else F.col(c) for c in internal]
    )
    value = "_value" if "value" in clash else "value"
    keep = [f"_{c}" if c in clash else c for c in internal]
    return apply_schema(renamed, schema, value, keep)


def topic_views(
    spark: SparkSession,
    source: TopicSource,
    schemas: Mapping[str, T.StructType],
    include_internal: bool = False,
    prefix: str = "",
) -> list[str]:
    """Make topics queryable by name in ``spark.sql``; returns the view names.

    Only the topics of ``schemas`` become views.  Characters that a plain SQL
    name cannot hold are written as ``_``.
    """
    names = []
    for topic, schema in schemas.items():
        log = read_topic(spark, replace(source, topics=(topic,), pattern=None))
        name = prefix + re.sub(r"\W", "_", topic)
        if name in names:
            raise ValueError(f"two topics want the view name {name}")
        topic_table(log, topic, schema, include_internal).createOrReplaceTempView(name)
        names.append(name)
    return names


def decoded(messages: DataFrame, strict: bool = False) -> DataFrame:
    """The log with ``key`` and ``value`` as text."""
    return messages.withColumns(
        {
            "key": decode_text(F.col("key"), strict),
            "value": decode_text(F.col("value"), strict),
        }
    )
