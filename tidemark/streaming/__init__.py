"""Sinks and running queries; all progress lives in checkpoints."""

from tidemark.streaming.kpi import (
    KpiStore,
    expiring_kpi,
    expiring_totals,
    kpi_per_batch,
    read_kpi_store,
    running_kpi,
)
from tidemark.streaming.queries import DeliveryLog, delivery_counts, run_all, start, with_delivery
from tidemark.streaming.sinks import (
    as_documents,
    deliver,
    store_documents,
    store_topic_catalog,
    stream_documents,
    stream_messages,
    stream_rejected,
    stream_to_topic,
    topic_catalog,
    write_topic,
)

__all__ = [
    "DeliveryLog",
    "KpiStore",
    "as_documents",
    "deliver",
    "delivery_counts",
    "expiring_kpi",
    "expiring_totals",
    "kpi_per_batch",
    "read_kpi_store",
    "run_all",
    "running_kpi",
    "start",
    "store_documents",
    "store_topic_catalog",
    "stream_documents",
    "stream_messages",
    "stream_rejected",
    "stream_to_topic",
    "topic_catalog",
    "with_delivery",
    "write_topic",
]
