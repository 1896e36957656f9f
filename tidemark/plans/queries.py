"""One registered query per operator; each reads whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rowtext import (
    iso_timestamps,
    row_cells,
    row_json_array,
    row_json_object,
)
from tidemark.functions.values import (
    LINE_SUFFIX,
    MESSAGE_SUFFIX,
    append_suffix,
    text_bytes,
    wrap_document,
)
from tidemark.operators.counting import kpi_count, kpi_totals, latest_kpi, produced_row_count
from tidemark.operators.parsing import (
    apply_schema,
    document_field,
    flatten_struct,
    infer_schema,
    only_documents,
    parse_documents,
    parse_struct,
)
from tidemark.operators.polling import LARGEST_LIMIT, POLL_ROWS, Mark, TableWatch, high_water_mark, poll
from tidemark.operators.topic_stats import list_topics, topic_partitions, topic_peek
from tidemark.operators.union import tables_to_topic
from tidemark.plans.flows import publish_tables, topic_to_documents, topic_to_kpi, topic_to_table
from tidemark.plans.relations import messages, mixed_messages, table
from tidemark.session import configure, run_dir
from tidemark.sources.documents import (
    collection_scan,
    read_documents,
    read_messages,
    rejected_messages,
)
from tidemark.sources.page_chain import page_order
from tidemark.sources.pages import flatten_pages, page_schema, result_pages
from tidemark.sources.table_stream import stream_table
from tidemark.sources.tables import qualified_scan, text_lines
from tidemark.sources.topics import (
    TopicSource,
    decoded,
    read_topic,
    stream_topic,
    topic_table,
    topic_views,
    utc_time,
)
from tidemark.streaming.kpi import expiring_kpi, expiring_totals, read_kpi_store, running_kpi
from tidemark.streaming.queries import DeliveryLog, run_all, start, with_delivery
from tidemark.streaming.sinks import (
    deliver,
    store_documents,
    store_topic_catalog,
    stream_messages,
    stream_rejected,
    stream_to_topic,
    write_topic,
)

Query = Callable[[SparkSession, str], DataFrame]

MARK = Mark("2024-01-15 00:00:00")
EVENT_PAYLOAD = T.StructType([T.StructField("k", T.LongType())])
_LOG = ["topic", "partition", "offset", "key", "value"]

_REGISTRY: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _REGISTRY[name] = lambda spark, sf_dir: function(configure(spark), sf_dir)
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", text_bytes(F.col("props")).alias("value"))


_TOPIC_FOLDERS: dict[tuple[str, str], TopicSource] = {}


def _topic_folder(spark: SparkSession, sf_dir: str) -> TopicSource:
    """The event log as a topic directory, written once per application and shared by the queries."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _TOPIC_FOLDERS:
        path = run_dir(spark, "topics")
        write_topic(messages(spark, sf_dir), format="parquet", path=path)
        _TOPIC_FOLDERS[known] = TopicSource(format="parquet", path=path)
    return _TOPIC_FOLDERS[known]


# --- sources -------------------------------------------------------------


@_query("topic_envelope")
def _topic_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = decoded(read_topic(spark, _topic_folder(spark, sf_dir)))
    return log.select(*_LOG, utc_time(F.col("timestamp")).alias("timestamp"))


@_query("multi_topic_read")
def _multi_topic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _topic_folder(spark, sf_dir)
    source = TopicSource(("click", "view"), format="parquet", path=folder.path)
    return decoded(read_topic(spark, source)).select(*_LOG)


@_query("pattern_read")
def _pattern_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _topic_folder(spark, sf_dir)
    source = TopicSource(pattern="(click|.*up)", format="parquet", path=folder.path)
    return decoded(read_topic(spark, source)).select(*_LOG)


@_query("replay_from_earliest")
def _replay_from_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    stream = decoded(stream_topic(spark, source, "earliest")).select(*_LOG)
    out = run_dir(spark, "replayed")
    start(stream, f"{out}-checkpoint", path=out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@_query("start_from_latest")
def _start_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = messages(spark, sf_dir)
    early = F.col("timestamp") < F.lit(MARK.cursor).cast("timestamp_ntz")
    path, out = run_dir(spark, "topics"), run_dir(spark, "latest")
    write_topic(log.where(early), format="parquet", path=path)
    source = TopicSource(format="parquet", path=path)
    stream = decoded(stream_topic(spark, source, "latest", f"{out}-start")).select(*_LOG)
    write_topic(log.where(~early), format="parquet", path=path)
    start(stream, f"{out}-checkpoint", path=out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@_query("table_scan")
def _table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


@_query("qualified_scan")
def _qualified_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"customer_{zlib.crc32(sf_dir.encode()):08x}"
    location = f"{sf_dir}/customer.parquet".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS default.{name} USING parquet LOCATION '{location}'")
    found = qualified_scan(spark, f"spark_catalog.default.{name}")
    spark.sql(f"DROP TABLE default.{name}")  # the plan goes by the files, which stay
    return found


@_query("paged_result_flatten")
def _paged_result_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "pages")
    result_pages(table(spark, sf_dir, "customer")).write.parquet(path)
    pages = spark.read.schema("body string, n_rows int").parquet(path)
    return flatten_pages(pages, page_schema(pages))


@_query("build_result_pages")
def _build_result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return flatten_pages(result_pages(orders), orders.schema)


@_query("text_line_suffix")
def _text_line_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.explode(F.split("text", "\n")).alias("value")
    documents = table(spark, sf_dir, "documents").select("doc_id", lines)
    return documents.select("doc_id", append_suffix(F.col("value"), LINE_SUFFIX).alias("value"))


@_query("text_file_suffix")
def _text_file_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = text_lines(spark, path)
    return lines.select(append_suffix(F.col("value"), LINE_SUFFIX).alias("value"))


@_query("incremental_poll")
def _incremental_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return poll(events, "ts", "event_id", MARK, POLL_ROWS)


@_query("incremental_poll_all")
def _incremental_poll_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poll(table(spark, sf_dir, "events"), "ts", "event_id", MARK)


@_query("hide_internal_columns")
def _hide_internal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_table(messages(spark, sf_dir), "click", EVENT_PAYLOAD)


@_query("topic_sql")
def _topic_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    topics = {name: EVENT_PAYLOAD for name in ("click", "view")}
    click, view = topic_views(spark, source, topics, prefix="topic_")
    return spark.sql(
        f"SELECT k, count(*) AS n FROM (SELECT k FROM {click} UNION ALL SELECT k FROM {view})"
        " GROUP BY k"
    )


@_query("internal_columns")
def _internal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = decoded(messages(spark, sf_dir))
    return topic_table(log, "click", EVENT_PAYLOAD, include_internal=True)


def _routed(spark: SparkSession, sf_dir: str) -> str:
    source = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "collections")
    stream = stream_topic(spark, source, "earliest")
    stream_messages(stream, store, f"{store}-checkpoint").awaitTermination()
    return store


@_query("collection_scan")
def _collection_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_messages(spark, _routed(spark, sf_dir), "click")


@_query("document_scan")
def _document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = run_dir(spark, "documents")
    store_documents(messages(spark, sf_dir), store)
    click = collection_scan(spark, store, "click")
    return click.select(document_field("doc", "$.k", "bigint").alias("k"))


# --- projections ---------------------------------------------------------


@_query("decode_value")
def _decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = messages(spark, sf_dir)
    return decoded(log, strict=True).select("topic", "partition", "offset", "value")


@_query("append_suffix")
def _append_message_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(
        append_suffix(F.col("value"), MESSAGE_SUFFIX).alias("Result")
    )


@_query("parse_json_struct")
def _parse_json_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_struct(_event_messages(spark, sf_dir), EVENT_PAYLOAD, out="payload")
    return parsed.select("event_id", F.col("payload.k").alias("k"))


@_query("infer_json_schema")
def _infer_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_messages(spark, sf_dir)
    return apply_schema(events, infer_schema(events), keep=["event_id"])


@_query("infer_open_keys")
def _infer_open_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by customer, whose keys are the names of an object."""
    price = F.create_map(F.col("o_custkey").cast("string"), F.col("o_totalprice"))
    document = F.struct(F.col("o_orderkey").alias("order"), price.alias("prices"))
    orders = table(spark, sf_dir, "orders").select(F.to_json(document).alias("value"))
    rows = apply_schema(orders, infer_schema(orders, most_keys=50))
    return rows.select("order", F.explode("prices").alias("customer", "price"))


@_query("flatten_struct")
def _flatten_parsed_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_struct(_event_messages(spark, sf_dir), EVENT_PAYLOAD)
    return flatten_struct(parsed, keep=["event_id"])


@_query("classify_messages")
def _classify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(mixed_messages(spark, sf_dir), doc=None).select("id", "status")


@_query("parse_document")
def _parse_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = only_documents(_event_messages(spark, sf_dir))
    return documents.select("event_id", document_field("doc", "$.k", "bigint").alias("k"))


@_query("row_to_json_array")
def _row_to_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(row_json_array(customer).alias("value"))


@_query("row_to_json_object")
def _row_to_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(row_json_object(orders).alias("value"))


@_query("iso_timestamps")
def _iso_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("ts_iso"))
    return iso_timestamps(events)


@_query("iso_instants")
def _iso_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    instants = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    return iso_timestamps(table(spark, sf_dir, "events").select("event_id", instants.alias("at")))


@_query("iso_nested_times")
def _iso_nested_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    times = F.struct(F.array("ts", day).alias("at")).alias("e")
    nested = iso_timestamps(table(spark, sf_dir, "events").select("event_id", times))
    return nested.select("event_id", F.col("e.at")[0].alias("ts"), F.col("e.at")[1].alias("day"))


@_query("wrap_document")
def _wrap_message_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrap_document(messages(spark, sf_dir))


@_query("text_serialise")
def _text_serialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = F.hex(text_bytes(F.col("value"))).alias("bytes")
    return table(spark, sf_dir, "events").select("event_id", sent)


@_query("row_cells")
def _cells_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_cells(table(spark, sf_dir, "customer"), ["c_custkey"])


# --- counts and topic statistics -----------------------------------------


@_query("kpi_count")
def _kpi_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = only_documents(messages(spark, sf_dir))
    return kpi_count(documents.select(document_field("doc", "$.k", "bigint").alias("k")), "k")


@_query("route_by_topic")
def _route_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_count(read_messages(spark, _routed(spark, sf_dir)), "topic", count="n")


@_query("list_topics")
def _topics_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_topics(messages(spark, sf_dir))


@_query("topic_partitions")
def _partitions_of_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topic_partitions(messages(spark, sf_dir))
    return found.withColumn("partitions", F.array_join("partitions", ","))


@_query("topic_peek")
def _first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(topic_peek(messages(spark, sf_dir)))


@_query("topic_peek_stored")
def _topic_peek_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    return decoded(topic_peek(read_topic(spark, source), prune=True))


@_query("topic_catalog")
def _topic_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "topic-catalog")
    store_topic_catalog(list_topics(messages(spark, sf_dir)), path)
    return spark.read.schema("topic string").parquet(path)


@_query("high_water_mark")
def _last_check_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(table(spark, sf_dir, "events"), "ts")
    return mark.withColumnRenamed("ts", "last_check_time")


@_query("last_position")
def _last_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey")


# --- many tables into one topic ------------------------------------------

_PUBLISHED = ["region", "nation", "customer", "supplier", "orders"]


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in _PUBLISHED}


@_query("tables_to_topic")
def _many_tables_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables_to_topic(_tables(spark, sf_dir))


@_query("produced_row_count")
def _produced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return produced_row_count(tables_to_topic(_tables(spark, sf_dir)))


@_query("published_messages")
def _published_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "published")
    tables = _tables(spark, sf_dir)
    publish_tables(
        spark,
        tables,
        "tables",
        row_format="object",
        together=True,
        format="parquet",
        path=path,
        tables=tables,
    )
    log = read_topic(spark, TopicSource(("tables",), format="parquet", path=path))
    return decoded(log).select("value")


# --- streams and watchers ------------------------------------------------


@_query("stream_quarantine")
def _stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, store = run_dir(spark, "mixed"), run_dir(spark, "documents")
    mixed = mixed_messages(spark, sf_dir).withColumnRenamed("id", "key")
    write_topic(mixed, "mixed", format="parquet", path=path)
    source = TopicSource(("mixed",), format="parquet", path=path)
    topic_to_documents(spark, source, store, f"{store}-checkpoint").awaitTermination()
    return read_documents(spark, store).select(
        F.col("key").cast("string").alias("id"),
        "status",
        F.coalesce(F.col("raw").cast("string"), F.lit("")).alias("raw"),
    )


@_query("stream_typed_table")
def _stream_typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    out = run_dir(spark, "typed")
    topic_to_table(spark, source, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema("topic string, k bigint").parquet(out)


def _drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which four in five are not what the first ones were."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 5
    value = (
        F.when(kind == 0, F.concat(F.lit('{"k":'), k, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"k":"x'), k, F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"extra":1,"k":'), k, F.lit("}")))
        .when(kind == 3, F.concat(F.lit('{"K":'), k, F.lit("}")))
        .otherwise(F.concat(F.lit("junk "), k))
    )
    return table(spark, sf_dir, "events").select(kind.alias("kind"), value.alias("value"))


@_query("stream_typed_drift")
def _stream_typed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed table whose stream is started on clean messages and again on all others."""
    path, out = run_dir(spark, "drift"), run_dir(spark, "typed")
    log, source = _drifting(spark, sf_dir), TopicSource(("t",), format="parquet", path=path)
    for part in (log.where("kind = 0"), log.where("kind <> 0")):
        write_topic(part.drop("kind"), "t", format="parquet", path=path)
        topic_to_table(spark, source, out, f"{out}-checkpoint", quarantine=True).awaitTermination()
    columns = "k bigint, _rest variant, _raw binary, _status string, topic string"
    return spark.read.schema(columns).parquet(out).select(
        "k", F.to_json("_rest").alias("rest"), F.col("_status").alias("status"), F.col("_raw").cast("string").alias("raw")
    )


@_query("document_scan_text")
def _document_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document store in a format without variants."""
    store = run_dir(spark, "documents")
    stored = {"format": "json", "options": {"compression": "gzip"}}
    source, checkpoint = _topic_folder(spark, sf_dir), f"{store}-checkpoint"
    topic_to_documents(spark, source, store, checkpoint, **stored).awaitTermination()
    click = collection_scan(spark, store, "click", **stored)
    return click.select(document_field("doc", "$.k", "bigint").alias("k"))


@_query("stream_interval")
def _stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that polls every second and finds what arrives while it runs."""
    path, out = run_dir(spark, "topics"), run_dir(spark, "polled")
    log = messages(spark, sf_dir)
    early = F.col("timestamp") < F.lit(MARK.cursor).cast("timestamp_ntz")
    write_topic(log.where(early), format="parquet", path=path)
    stream = decoded(stream_topic(spark, TopicSource(format="parquet", path=path), "earliest"))
    query = start(stream.select(*_LOG), f"{out}-checkpoint", path=out, every="1 second")
    try:
        query.processAllAvailable()
        write_topic(log.where(~early), format="parquet", path=path)
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(stream.select(*_LOG).schema).parquet(out)


@_query("stream_rejected")
def _stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = run_dir(spark, "mixed"), run_dir(spark, "rejected")
    mixed = mixed_messages(spark, sf_dir).withColumnRenamed("id", "key")
    write_topic(mixed, "mixed", format="parquet", path=path)
    stream = stream_topic(spark, TopicSource(format="parquet", path=path), "earliest")
    stream_rejected(stream, out, f"{out}-checkpoint").awaitTermination()
    return rejected_messages(spark, out).select(
        F.col("key").cast("string").alias("id"), "status", F.col("raw").cast("string").alias("raw")
    )


@_query("topic_copy")
def _topic_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    out = run_dir(spark, "copied")
    stream = stream_topic(spark, source, "earliest")
    stream_to_topic(stream, f"{out}-checkpoint", format="parquet", path=out).awaitTermination()
    return decoded(read_topic(spark, TopicSource(format="parquet", path=out))).select(*_LOG)


@_query("stream_kpi")
def _stream_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "kpi")
    checkpoint = f"{store}-checkpoint"
    topic_to_kpi(
        spark, source, ["k"], store, checkpoint, schema=EVENT_PAYLOAD
    ).awaitTermination()
    return kpi_totals(read_kpi_store(spark, store, EVENT_PAYLOAD, checkpoint), "k")


@_query("stream_running_kpi")
def _stream_running_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "kpi")
    stream = stream_topic(spark, source, "earliest")
    rows = apply_schema(stream, EVENT_PAYLOAD)
    checkpoint = f"{store}-checkpoint"
    running_kpi(rows, "k", store=store, checkpoint=checkpoint).awaitTermination()
    return latest_kpi(read_kpi_store(spark, store, EVENT_PAYLOAD, checkpoint), "k")


@_query("stream_expiring_kpi")
def _stream_expiring_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In bounded batches, with counts that expire in between."""
    source = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "kpi")
    stream = stream_topic(spark, source, "earliest", max_per_trigger=10)
    checkpoint = f"{store}-checkpoint"
    rows = apply_schema(stream, EVENT_PAYLOAD)
    idle = timedelta(milliseconds=500)
    expiring_kpi(rows, "k", idle=idle, store=store, checkpoint=checkpoint).awaitTermination()
    return expiring_totals(spark, store, EVENT_PAYLOAD, checkpoint)


@_query("stream_fan_out")
def _stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "collections")
    queries = [
        topic_to_documents(
            spark,
            TopicSource((name,), format="parquet", path=folder.path),
            f"{store}/{name}",
            f"{store}-checkpoint/{name}",
        )
        for name in ("click", "view")
    ]
    run_all(queries)
    found = read_documents(spark, f"{store}/click").unionByName(
        read_documents(spark, f"{store}/view")
    )
    return found.select("topic", document_field("doc", "$.k", "bigint").alias("k"))


@_query("delivery_report")
def _delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _topic_folder(spark, sf_dir)
    store = run_dir(spark, "delivered")
    report = f"{store}-report"
    stream = stream_topic(spark, source, "earliest")
    start(
        stream,
        f"{store}-checkpoint",
        each_batch=lambda batch, number: deliver(batch, number, store, report),
    ).awaitTermination()
    columns = "topic string, partition int, status string, count bigint, batch_id bigint"
    batches = spark.read.schema(columns).parquet(report)
    return kpi_totals(batches, "topic", "partition", "status")


@_query("watched_table")
def _watched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of a table that grows in the midst of equal cursor values."""
    out = run_dir(spark, "watched")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    date, key = F.col("o_orderdate"), F.col("o_orderkey")

    def until(day: str, last: int) -> DataFrame:
        cut = F.lit(day).cast("timestamp_ntz")
        return orders.where((date < cut) | ((date == cut) & (key <= last)))

    grown = [until("1995-06-17", 700), until("1998-03-01", 900), orders]
    now = [grown[0]]
    watch = TableWatch(spark, lambda: now[-1], "o_orderdate", "o_orderkey", out, f"{out}-mark")
    for state in grown:
        now.append(state)
        watch.advance()
    return watch.seen()


@_query("watched_table_nulls")
def _watched_table_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order has no date; with and without a limit each order comes once."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate")).alias("o_orderdate")
    )
    found = []
    for limit in (None, LARGEST_LIMIT // 2):
        out = run_dir(spark, "watched")
        watch = TableWatch(spark, lambda: orders, "o_orderdate", "o_orderkey", out, f"{out}-mark", limit)
        while watch.advance(all_polls=True):
            pass
        found.append(watch.seen().select(F.lit(limit is not None).alias("limited"), *orders.columns))
    return found[0].unionByName(found[1])


@_query("watched_stream")
def _watched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The growing table of ``watched_table`` as a stream, whose checkpoint alone knows how far it came."""
    out = run_dir(spark, "watched-stream")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    date, key = F.col("o_orderdate"), F.col("o_orderkey")

    def until(day: str, last: int) -> Column:
        cut = F.lit(day).cast("timestamp_ntz")
        return (date < cut) | ((date == cut) & (key <= last))

    first, second = until("1995-06-17", 700), until("1998-03-01", 900)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/seen/poll={number}")

    for grown in (first, second & ~first, ~second):
        orders.where(grown).write.mode("append").parquet(f"{out}/table")
        stream = stream_table(spark, f"{out}/table", orders.schema, "o_orderdate", "o_orderkey")
        start(stream, f"{out}/checkpoint", each_batch=save).awaitTermination()
    return spark.read.schema(T.StructType([*orders.schema.fields, T.StructField("poll", T.LongType())])).parquet(
        f"{out}/seen"
    )


@_query("late_rows")
def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth order is late: by less than the overlap it comes once, by more it does not come."""
    out = run_dir(spark, "late")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    prompt, date = F.col("o_orderkey") % 4 > 0, F.col("o_orderdate")
    day = {d: F.lit(d).cast("timestamp_ntz") for d in ("1995-05-01", "1995-06-01", "1997-01-01")}
    grown = [
        orders.where(prompt & (date < day["1995-06-01"])),
        orders.where((date < day["1997-01-01"]) & (prompt | (date >= day["1995-05-01"]))),
        orders,
    ]
    now = [grown[0]]
    watch = TableWatch(
        spark, lambda: now[-1], "o_orderdate", "o_orderkey", out, f"{out}-mark", overlap="90 days"
    )
    for state in grown:
        now.append(state)
        watch.advance()
    return watch.seen()


@_query("page_order")
def _page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 500 orders in their order, once complete and once without the eighth."""
    number = F.floor(F.col("o_orderkey") / 500)
    pages = table(spark, sf_dir, "orders").groupBy(number.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    following = pages.select((F.col("i") - 1).alias("i"), F.col("i").alias("next"))

    def uri(i: str) -> Column:
        return F.concat(F.lit("statement/"), F.md5(F.col(i).cast("string").cast("binary")))

    chain = pages.join(following, "i", "left").select("i", uri("i").alias("uri"), uri("next").alias("next_uri"))
    found = []
    for name, some in (("whole", chain), ("gap", chain.where("i <> 7"))):
        placed = page_order(some).join(some.select("i", "uri"), "uri")
        found.append(placed.select(F.lit(name).alias("pages"), "i", "page", "state"))
    return found[0].unionByName(found[1])


@_query("delivery_log")
def _delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a stream of many batches reported as delivered; those of partition 3 count as failed."""
    out = run_dir(spark, "delivery-log")
    log = DeliveryLog(spark, f"{out}/reports", lot=3)
    stream = stream_topic(spark, _topic_folder(spark, sf_dir), "earliest", max_per_trigger=1)
    counted = with_delivery(stream, F.col("partition") == 3)
    spark.streams.addListener(log)
    try:
        query = start(counted, f"{out}/checkpoint", path=f"{out}/messages")
        query.awaitTermination()
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    return log.read().agg(F.sum("messages").alias("messages"), F.sum("failed").alias("failed"))
