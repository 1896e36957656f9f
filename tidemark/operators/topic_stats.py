"""What is in a topic log: its topics, their partitions, their first messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INTERNAL_PREFIX = "__"  # fixed value: names of internal topics start with it
PRUNED_TOPICS = 500  # one condition each
PEEK_ROWS = 6  # fixed value: messages shown per topic


def list_topics(messages: DataFrame, internal: bool = False) -> DataFrame:
    """The distinct topics, without internal ones unless asked for."""
    topics = messages.select("topic")
    if not internal:
        topics = topics.where(~F.col("topic").startswith(INTERNAL_PREFIX))
    return topics.distinct()


def topic_partitions(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """``topic``, its sorted ``partitions`` and ``n_messages``; an unknown topic gives no row.

    Counted per (topic, partition) first, so the list per topic is built
    from one small row per partition and never from messages.
    """
    if topic is not None:
        messages = messages.where(F.col("topic") == topic)
    per_partition = messages.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per_partition.groupBy("topic").agg(
        F.array_sort(F.collect_list("partition")).alias("partitions"),
        F.sum("n").alias("n_messages"),
    )


def topic_peek(messages: DataFrame, rows: int = PEEK_ROWS, prune: bool = False) -> DataFrame:
    """The first ``rows`` messages of each topic in (partition, offset) order.

    Ranked per (topic, partition) and then per topic.  Spark keeps at most
    ``rows`` rows per group in every task before each shuffle, so a topic
    that holds most of the log is never gathered in one place.

    With ``prune`` the positions are ranked first, without the messages, and
    the largest one found of each topic bounds the read of that topic.  In a
    topic directory that skips almost every row group; it runs one narrow job
    when the plan is made.  Beyond ``PRUNED_TOPICS`` topics nothing is pruned.
    """
    if not rows < 1000:
        raise ValueError("a peek is a handful of rows; read the topic for more")
    if prune:
        positions = _first_rows(messages.select("topic", "partition", "offset"), rows)
        ends = positions.groupBy("topic").agg(F.max("offset").alias("last"))
        found = ends.limit(PRUNED_TOPICS + 1).collect()
        if len(found) <= PRUNED_TOPICS:
            bounds = [
                F.col("topic").eqNullSafe(F.lit(r["topic"]))
                & (F.col("offset").isNull() | (F.col("offset") <= F.lit(r["last"])))
                for r in found
            ]
            messages = messages.where(reduce(Column.__or__, bounds, F.lit(False)))
    return _first_rows(messages, rows).select("topic", "partition", "offset", "key", "value")


def _first_rows(messages: DataFrame, rows: int) -> DataFrame:
    within = Window.partitionBy("topic", "partition").orderBy("offset")
    across = Window.partitionBy("topic").orderBy("partition", "offset")
    return (
        messages.withColumn("__rank", F.row_number().over(within))
        .where(F.col("__rank") <= rows)
        .withColumn("__rank", F.row_number().over(across))
        .where(F.col("__rank") <= rows)
    )
