"""Operators on topics, tables and messages: ``DataFrame -> DataFrame``."""

from tidemark.operators.counting import kpi_count, kpi_totals, latest_kpi, produced_row_count
from tidemark.operators.parsing import (
    MALFORMED,
    NOT_DOCUMENT,
    STORED,
    UNPARSED,
    apply_schema,
    flatten_struct,
    infer_schema,
    only_documents,
    parse_documents,
    parse_struct,
    typed_messages,
)
from tidemark.operators.polling import Mark, TableWatch, high_water_mark, poll, poll_late
from tidemark.operators.topic_stats import list_topics, topic_partitions, topic_peek
from tidemark.operators.union import tables_to_topic

__all__ = [
    "MALFORMED",
    "NOT_DOCUMENT",
    "STORED",
    "Mark",
    "TableWatch",
    "UNPARSED",
    "apply_schema",
    "flatten_struct",
    "high_water_mark",
    "infer_schema",
    "kpi_count",
    "kpi_totals",
    "latest_kpi",
    "list_topics",
    "only_documents",
    "parse_documents",
    "parse_struct",
    "poll",
    "poll_late",
    "produced_row_count",
    "tables_to_topic",
    "topic_partitions",
    "topic_peek",
    "typed_messages",
]
