"""End-to-end flows and the registered queries."""

from tidemark.plans.flows import (
    PublishReport,
    publish_tables,
    topic_to_documents,
    topic_to_kpi,
    topic_to_table,
    watch_table,
)

__all__ = [
    "PublishReport",
    "publish_tables",
    "topic_to_documents",
    "topic_to_kpi",
    "topic_to_table",
    "watch_table",
]
