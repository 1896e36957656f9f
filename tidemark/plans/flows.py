"""The jobs the library exists for, each a short composition of operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.parsing import REST, apply_schema, infer_schema, typed_messages
from tidemark.operators.polling import TableWatch
from tidemark.operators.union import tables_to_topic
from tidemark.sources.pages import result_pages
from tidemark.sources.tables import first_line, resolve_tables
from tidemark.sources.topics import TopicSource, read_topic, stream_topic
from tidemark.streaming.kpi import KpiStore, kpi_per_batch
from tidemark.streaming.queries import start
from tidemark.streaming.sinks import stream_documents, write_topic


@dataclass(frozen=True)
class PublishReport:
    """What became of one table."""

    table: str
    rows: int | None
    error: str | None


def publish_tables(
    spark: SparkSession,
    names: Iterable[str],
    topic: str,
    *,
    row_format: str = "array",
    rows_per_page: int = 1000,
    together: bool = False,
    format: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> list[PublishReport]:
    """Publish every row of the named tables to one topic.

    ``row_format`` is ``array``, ``object`` or ``pages`` (result envelopes).
    A table that cannot be read or sent is reported and the next one follows.
    ``together`` sends all readable tables in one job, which keeps a cluster
    busy when many are small; a failure while sending then concerns them all.
    """
    names = list(names)
    if tables is None:
        found, failed = resolve_tables(spark, names)
    else:
        found = {n: tables[n] for n in names if n in tables}
        failed = {n: "no such table" for n in names if n not in tables}
    reports = {name: PublishReport(name, None, reason) for name, reason in failed.items()}

    def send(group: list[str]) -> None:
        sent = {name: Observation() for name in group}
        messages = [
            _table_messages(name, found[name], row_format, rows_per_page, sent[name])
            for name in group
        ]
        try:
            everything = reduce(DataFrame.unionByName, messages)
            write_topic(everything, topic, format=format, path=path, options=options)
            for name in group:
                reports[name] = PublishReport(name, sent[name].get["rows"] or 0, None)
        except (PySparkException, Py4JJavaError) as error:
            reason = first_line(error)
            reports.update({name: PublishReport(name, None, reason) for name in group})

    for group in ([list(found)] if together and found else [[name] for name in found]):
        send(group)
    return [reports[name] for name in dict.fromkeys(names)]


def _table_messages(
    name: str, table: DataFrame, row_format: str, rows_per_page: int, sent: Observation
) -> DataFrame:
    if row_format == "pages":
        pages = result_pages(table, rows_per_page).withColumnRenamed("body", "value")
        return pages.observe(sent, F.sum("n_rows").alias("rows")).select("value")
    messages = tables_to_topic({name: table}, row_format)
    return messages.observe(sent, F.count(F.lit(1)).alias("rows")).select("value")


def topic_to_documents(
    spark: SparkSession,
    source: TopicSource,
    path: str | None,
    checkpoint: str,
    *,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    every: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Topics into the document store, whatever they carry; a connector needs no ``path``."""
    messages = stream_topic(
        spark, source, starting, state=f"{checkpoint}-start", max_per_trigger=max_per_trigger
    )
    return stream_documents(
        messages, path, checkpoint, every=every, format=format, options=options
    )


def stored_schema(
    spark: SparkSession, source: TopicSource, state: str, sample: int | None = None
) -> T.StructType:
    """The schema inferred at the first start of a stream, kept under ``state`` from then on."""
    try:
        known = spark.read.text(state, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is None:
        schema = infer_schema(read_topic(spark, source), sample=sample)
        text = spark.range(0, 1, 1, 1).select(F.lit(schema.json()).alias("value"))
        text.write.mode("overwrite").text(state)
        return schema
    return T.StructType.fromJson(json.loads(known["value"]))


def topic_to_table(
    spark: SparkSession,
    source: TopicSource,
    path: str | None,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    sample: int | None = None,
    rest: str | None = REST,
    quarantine: bool = False,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    every: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """The JSON objects of topics as typed columns, next to their topic.

    Without a schema, it is inferred at the first start and stored beside the
    checkpoint, so a restart goes on with the same columns.  An object with
    unknown fields, or with values that do not fit their type, is kept whole
    in the variant column ``rest``; None leaves that column out.  With
    ``quarantine`` other messages go to the same table, under their
    ``_status`` with their bytes in ``_raw``: table rows are then the input.

    Files are kept in one folder per topic; other formats get the topic as a
    column, called ``_topic`` where the documents have a ``topic`` of their own.
    """
    if schema is None:
        schema = stored_schema(spark, source, f"{checkpoint}-schema", sample)
    messages = stream_topic(
        spark, source, starting, state=f"{checkpoint}-start", max_per_trigger=max_per_trigger
    )
    name = "_topic" if "topic" in schema.fieldNames() else "topic"
    messages = messages.withColumnRenamed("topic", name)
    if quarantine:
        rows, by = typed_messages(messages, schema, keep=[name], rest=rest), ("_status", name)
    elif rest:
        rows, by = typed_messages(messages, schema, keep=[name], rest=rest, others=False), (name,)
    else:
        rows, by = apply_schema(messages, schema, keep=[name]), (name,)
    return start(
        rows,
        checkpoint,
        format=format,
        path=path,
        options=options,
        partition_by=by if path else (),
        every=every,
    )


def topic_to_kpi(
    spark: SparkSession,
    source: TopicSource,
    fields: list[str],
    store: str | KpiStore,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    sample: int | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Counts per group over the JSON objects of a topic; only the ``fields`` are parsed.

    Without a schema, it is inferred at the first start from what the topic
    holds then, or from a ``sample`` of that many objects, and kept.
    """
    if schema is None:
        schema = stored_schema(spark, source, f"{checkpoint}-schema", sample)
    wanted = T.StructType([f for f in schema.fields if f.name in fields])
    messages = stream_topic(
        spark, source, starting, state=f"{checkpoint}-start", max_per_trigger=max_per_trigger
    )
    rows = apply_schema(messages, wanted)
    return kpi_per_batch(rows, *fields, store=store, checkpoint=checkpoint, every=every)


def watch_table(
    spark: SparkSession,
    scan: Callable[[], DataFrame],
    cursor: str,
    key: str,
    out: str,
    state: str,
    *,
    limit: int | None = None,
) -> TableWatch:
    """Follow a growing table; call ``run`` or ``advance`` on the result."""
    return TableWatch(spark, scan, cursor, key, out, state, limit)
