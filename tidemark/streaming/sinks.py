"""Writing messages, documents and the topic catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.values import text_bytes, wrap_document
from tidemark.operators.counting import kpi_count
from tidemark.operators.parsing import STORED, parse_documents
from tidemark.sources.documents import VARIANT_FORMATS, stored_as
from tidemark.sources.topics import append_topic
from tidemark.streaming.queries import start

_TOPIC_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")


def broker_messages(df: DataFrame, topic: str | None = None) -> DataFrame:
    """The columns a broker takes: ``value`` and ``key`` as bytes, and the topic, if any."""
    columns = [text_bytes(F.col(c)).alias(c) for c in ("key", "value") if c in df.columns]
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    elif "topic" in df.columns:
        columns.append(F.col("topic"))
    return df.select(*columns)


def write_topic(
    df: DataFrame,
    topic: str | None = None,
    *,
    format: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    partitions: int = 1,
) -> None:
    """Publish ``value`` (and ``key``, when there is one) from the executors.

    To a broker, or appended to a topic directory when ``format`` is a file
    format.
    """
    if format != "kafka":
        append_topic(df, path, topic, partitions, format)
        return
    broker_messages(df, topic).write.format("kafka").options(**(options or {})).save()


def stream_to_topic(
    df: DataFrame,
    checkpoint: str,
    *,
    format: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Publish a stream of messages; a directory keeps the positions they came with."""
    if format == "kafka":
        messages, by = broker_messages(df), ()
    else:
        messages, by = df.select(*[F.col(c) for c in _TOPIC_COLUMNS if c in df.columns]), ("topic",)
    return start(
        messages,
        checkpoint,
        format=format,
        path=path,
        options=options,
        partition_by=by,
        every=every,
    )


def as_documents(messages: DataFrame, format: str = "parquet") -> DataFrame:
    """Messages in the columns of the document store.

    Objects become ``doc`` (JSON text where the format has no variant);
    whatever else arrived keeps its bytes in ``raw`` under the status that
    says why.  Stored plus rejected is the input.
    """
    parsed = parse_documents(messages)
    if format not in VARIANT_FORMATS:
        parsed = parsed.withColumn("doc", F.to_json("doc"))
    parsed = parsed.withColumn(
        "raw", F.when(F.col("status") != STORED, F.col("value").cast("binary"))
    )
    have = set(parsed.columns)
    return parsed.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in stored_as(format).fields
        ]
    )


def store_documents(
    messages: DataFrame,
    path: str,
    mode: str = "append",
    rebalance: bool = False,
    *,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a bounded set of messages to the document store.

    Nothing is shuffled: each task writes a file per topic it meets.  With
    very many topics those files get small; ``rebalance`` then shuffles the
    rows by folder first.  Small topics end up in few files, and a topic that
    holds most of the rows is still split over many tasks.
    """
    documents = as_documents(messages, format)
    if rebalance:
        documents = documents.hint("rebalance", "status", "topic")
    writer = documents.write.format(format).options(**(options or {})).mode(mode)
    writer.partitionBy("status", "topic").save(path)


def stream_documents(
    messages: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    every: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Route a stream of many topics into the document store, one folder per topic.

    One query for all topics, malformed messages included; nothing is
    shuffled.  The file sink commits each batch once, so a restart on the
    same checkpoint adds no rows.
    """
    return start(
        as_documents(messages, format),
        checkpoint,
        format=format,
        options=options,
        path=path,
        partition_by=("status", "topic") if path else (),
        every=every,
    )


def stream_rejected(
    messages: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    every: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Keep only what cannot become a document: the quarantine beside a typed table."""
    rejected = as_documents(messages, format).where(F.col("status") != STORED)
    return start(
        rejected,
        checkpoint,
        format=format,
        options=options,
        path=path,
        partition_by=("status", "topic") if path else (),
        every=every,
    )


def stream_messages(
    messages: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    every: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Route a stream of many topics as it is, each message wrapped as ``message``."""
    return start(
        wrap_document(messages),
        checkpoint,
        format=format,
        options=options,
        path=path,
        partition_by=("topic",) if path else (),
        every=every,
    )


def topic_catalog(topics: DataFrame, run_id: str | None = None) -> DataFrame:
    """One entry per topic, with the ``run_id`` that saw it when one is given."""
    entries = topics.select("topic").distinct()
    return entries if run_id is None else entries.withColumn("run_id", F.lit(run_id))


def store_topic_catalog(topics: DataFrame, path: str, run_id: str | None = None) -> None:
    """A snapshot of the topics; with ``run_id``, one more snapshot beside the earlier ones.

    Repeating a run replaces its own entries and no others.
    """
    target = path if run_id is None else f"{path}/run_id={run_id}"
    topic_catalog(topics).write.mode("overwrite").parquet(target)


def deliver(batch: DataFrame, batch_id: int, path: str, report: str) -> None:
    """Store one micro-batch and its delivery report, both keyed by the batch id.

    The report counts what was written, per topic, partition and status; it
    is read back from the written batch, so the batch is computed once.
    """
    target = f"{path}/batch_id={batch_id}"
    documents = as_documents(batch)
    documents.write.mode("overwrite").partitionBy("status", "topic").parquet(target)
    written = batch.sparkSession.read.schema(documents.schema).parquet(target)
    kpi_count(written, "topic", "partition", "status").write.mode("overwrite").parquet(
        f"{report}/batch_id={batch_id}"
    )
