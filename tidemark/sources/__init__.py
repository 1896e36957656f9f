"""Where data comes from: topics, tables, result pages, document collections."""

from tidemark.sources.documents import (
    collection_scan,
    read_documents,
    read_messages,
    rejected_messages,
)
from tidemark.sources.page_chain import page_order
from tidemark.sources.pages import flatten_pages, page_schema, page_schemas, pages_with, result_pages
from tidemark.sources.table_stream import TableStream, stream_table
from tidemark.sources.tables import (
    qualified_scan,
    resolve_tables,
    scan_jdbc,
    split_name,
    text_lines,
)
from tidemark.sources.topics import (
    ENVELOPE,
    TopicSource,
    append_topic,
    read_topic,
    stream_topic,
    topic_table,
    topic_views,
    utc_time,
)

__all__ = [
    "ENVELOPE",
    "TableStream",
    "TopicSource",
    "append_topic",
    "collection_scan",
    "flatten_pages",
    "page_order",
    "page_schema",
    "page_schemas",
    "pages_with",
    "qualified_scan",
    "read_documents",
    "read_messages",
    "read_topic",
    "rejected_messages",
    "resolve_tables",
    "result_pages",
    "scan_jdbc",
    "split_name",
    "stream_table",
    "stream_topic",
    "text_lines",
    "topic_table",
    "topic_views",
    "utc_time",
]
