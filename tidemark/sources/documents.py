"""Stored collections: one folder per topic, for documents also per status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.parsing import STORED

STORE = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
    .add("raw", T.BinaryType())
    .add("doc", T.VariantType())
    .add("status", T.StringType())
    .add("topic", T.StringType())
)


MESSAGES = T.StructType().add("message", T.StringType()).add("topic", T.StringType())


#: Formats that keep a variant; others hold documents as JSON text.
VARIANT_FORMATS = ("parquet", "delta", "iceberg")


def stored_as(format: str) -> T.StructType:
    """The columns of the document store in a format."""
    if format in VARIANT_FORMATS:
        return STORE
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "doc" else f.dataType) for f in STORE.fields]
    )


def _load(
    spark: SparkSession, path: str, schema: T.StructType, format: str, options: Mapping[str, str] | None
) -> DataFrame:
    return spark.read.format(format).options(**(options or {})).schema(schema).load(path)


def read_messages(
    spark: SparkSession,
    path: str,
    topic: str | None = None,
    *,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages stored as they came (``message``), of one topic or of all with ``topic``."""
    stored = _load(spark, path, MESSAGES, format, options)
    return stored if topic is None else stored.where(F.col("topic") == topic).select("message")


def read_documents(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All stored documents and rejected messages."""
    stored = _load(spark, path, stored_as(format), format, options)
    if format in VARIANT_FORMATS:
        return stored
    return stored.withColumn("doc", F.parse_json("doc"))


def collection_scan(spark: SparkSession, path: str, topic: str, **store) -> DataFrame:
    """The documents of one topic; only its folder is listed as input.  ``store``: format, options."""
    return read_documents(spark, path, **store).where(
        (F.col("status") == STORED) & (F.col("topic") == topic)
    )


def rejected_messages(spark: SparkSession, path: str, **store) -> DataFrame:
    """The quarantine: messages that could not become documents, with their raw bytes."""
    return read_documents(spark, path, **store).where(F.col("status") != STORED)
