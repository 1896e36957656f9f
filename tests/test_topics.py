"""Topic directories, subscriptions and topic statistics."""

import collections
import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import list_topics, topic_partitions, topic_peek
from tidemark.sources import TopicSource, append_topic, read_topic, stream_topic, topic_table, topic_views, utc_time
from tidemark.sources.topics import ENVELOPE


@pytest.fixture(scope="module")
def log(spark):
    rows = [("big", i % 3, i, f"k{i}", f"v{i}") for i in range(400)]
    rows += [("small", 5, 10 + i, None, f"s{i}") for i in range(4)]
    rows += [("__internal", 0, 0, None, "x"), ("007", 1, 3, None, "bond")]
    return spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, key string, value string"
    ).repartition(7)


def test_listing_leaves_out_internal_topics(log):
    assert {r[0] for r in list_topics(log).collect()} == {"big", "small", "007"}
    assert {r[0] for r in list_topics(log, internal=True).collect()} == {
        "big", "small", "007", "__internal",
    }


def test_partitions_of_a_topic(log):
    got = {r["topic"]: (r["partitions"], r["n_messages"]) for r in topic_partitions(log).collect()}
    assert got["big"] == ([0, 1, 2], 400) and got["small"] == ([5], 4)
    assert topic_partitions(log, "no such topic").collect() == []


def test_peek_takes_the_first_messages_of_each_topic(log):
    got = collections.defaultdict(list)
    for r in topic_peek(log).collect():
        got[r["topic"]].append((r["partition"], r["offset"]))
    assert sorted(got["big"]) == [(0, 3 * i) for i in range(6)]
    assert len(got["small"]) == 4 and len(got["__internal"]) == 1


def test_pruned_peek_is_the_same_and_bounds_the_scan(spark, log, folder):
    append_topic(log, folder)
    stored = read_topic(spark, TopicSource(format="parquet", path=folder))
    pruned = topic_peek(stored, prune=True)
    assert sorted(map(str, pruned.collect())) == sorted(map(str, topic_peek(stored).collect()))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "offset" in plan.split("PushedFilters")[1].split("]")[0]
    assert all(f"<= {end}" in plan for end in (15, 13, 0, 3))
    assert topic_peek(stored.where("topic = 'none'"), prune=True).isEmpty()


def test_peek_limits_every_task_before_each_shuffle(log):
    plan = topic_peek(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 6, Partial") == 2 and plan.count(", 6, Final") == 2


def test_a_directory_reads_like_a_broker(spark, log, folder):
    append_topic(log, folder)
    whole = read_topic(spark, TopicSource(format="parquet", path=folder))
    assert whole.schema.names == ENVELOPE.names
    assert whole.count() == log.count()
    named = TopicSource(("small", "007"), format="parquet", path=folder)
    assert {r[0] for r in read_topic(spark, named).select("topic").collect()} == {"small", "007"}
    pattern = TopicSource(pattern="s.*|b", format="parquet", path=folder)
    assert {r[0] for r in read_topic(spark, pattern).select("topic").collect()} == {"small"}
    plan = read_topic(spark, named)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [topic" in plan


def test_messages_keep_the_positions_they_bring(spark, folder):
    first = spark.range(1000).repartition(6).select(F.col("id").cast("string").alias("value"), (F.col("id") * 3).alias("offset"))
    append_topic(first, folder, "t", partitions=3)
    append_topic(first.select("value", F.lit("same").alias("key")), folder, "t", partitions=3)
    log = read_topic(spark, TopicSource(("t",), format="parquet", path=folder))
    assert log.count() == 2000
    given = log.where("key is null")
    assert {r["offset"] for r in given.collect()} == {3 * i for i in range(1000)}
    assert given.select("partition").distinct().count() == 3
    rest = log.where("key is not null")
    assert rest.where("offset is not null").isEmpty()
    assert rest.select("partition").distinct().count() == 1


def test_local_times_are_stored_as_utc(spark, folder):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = [datetime.datetime(2024, 3, 10, 2, 30), datetime.datetime(2024, 11, 3, 1, 30, 0, 5)]
        log = spark.createDataFrame([("x", t) for t in times], "value string, timestamp timestamp_ntz")
        append_topic(log, folder, "t")
        stored = read_topic(spark, TopicSource(("t",), format="parquet", path=folder))
        assert sorted(r[0] for r in stored.select(utc_time(F.col("timestamp"))).collect()) == times
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_topic_needs_a_name(spark, folder):
    with pytest.raises(ValueError, match="name a topic"):
        append_topic(spark.createDataFrame([("x",)], "value string"), folder)


def test_topic_as_table_hides_internal_columns(spark):
    rows = [("a", 0, 1, '{"k":1,"key":"own"}'), ("a", 0, 2, "junk"), ("b", 0, 3, '{"k":2}')]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    log = log.withColumn("key", F.lit("message key"))
    schema = T.StructType().add("k", T.LongType()).add("key", T.StringType())
    assert [tuple(r) for r in topic_table(log, "a", schema).collect()] == [(1, "own")]
    full = topic_table(log, "a", schema, include_internal=True).first().asDict()
    assert full == {
        "topic": "a", "partition": 0, "offset": 1, "_key": "message key",
        "value": '{"k":1,"key":"own"}', "k": 1, "key": "own",
    }


def test_topics_are_tables_in_sql(spark, folder):
    rows = [("a.b", '{"k":1}'), ("a.b", "junk"), ("c", '{"k":5}')]
    append_topic(spark.createDataFrame(rows, "topic string, value string"), folder)
    source = TopicSource(format="parquet", path=folder)
    schema = T.StructType().add("k", T.LongType())
    names = topic_views(spark, source, {"a.b": schema, "c": schema}, prefix="t_")
    assert names == ["t_a_b", "t_c"]
    assert spark.sql("SELECT * FROM t_a_b").collect() == [(1,)]
    with pytest.raises(ValueError, match="two topics"):
        topic_views(spark, source, {"a.b": schema, "a_b": schema})


def test_broker_options():
    source = TopicSource(("a", "b"), options={"kafka.bootstrap.servers": "broker:9092"})
    bounded = source.reader_options()
    assert bounded["subscribe"] == "a,b" and "startingOffsets" not in bounded
    assert int(bounded["maxRecordsPerPartition"]) > 0
    live = source.reader_options("latest")
    assert live["startingOffsets"] == "latest" and int(live["maxOffsetsPerTrigger"]) > 0
    assert source.reader_options("earliest", 5)["maxOffsetsPerTrigger"] == "5"
    assert TopicSource(pattern="t.*").reader_options()["subscribePattern"] == "t.*"
    own = TopicSource(("a",), options={"maxRecordsPerPartition": "7"})
    assert own.reader_options()["maxRecordsPerPartition"] == "7"


@pytest.mark.parametrize(
    "wrong",
    [
        {"topics": ("a",), "pattern": "b"},
        {},
        {"topics": ("a",), "format": "parquet"},
    ],
)
def test_incomplete_sources_are_refused(wrong):
    with pytest.raises(ValueError):
        TopicSource(**wrong)


def test_starting_position_is_checked(spark, folder):
    source = TopicSource(format="parquet", path=folder)
    with pytest.raises(ValueError, match="earliest"):
        stream_topic(spark, source, "somewhere")
    with pytest.raises(ValueError, match="state"):
        stream_topic(spark, source, "latest")
