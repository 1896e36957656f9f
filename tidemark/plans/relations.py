"""Topic logs and message sets derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import text_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _topic_name() -> Column:
    # One topic gets an internal name, so that the listing has something to leave out.
    return F.when(F.col("event_type") == "error", "__error").otherwise(F.col("event_type"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a topic log; the position of a message is its growing ``event_id``."""
    return table(spark, sf_dir, "events").select(
        _topic_name().alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        text_bytes(F.col("user_id")).alias("key"),
        text_bytes(F.col("props")).alias("value"),
        F.col("ts").alias("timestamp"),
    )


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects, JSON arrays and plain text, as they share a topic."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), "event_id").alias("id"), F.col("props").alias("value")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("value")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("id"),
        F.concat(F.lit('["'), "n_name", F.lit('"]')).alias("value"),
    )
    return events.unionByName(documents).unionByName(nations)
