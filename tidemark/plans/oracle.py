"""The same results in plain SQL over the given tables, to check the queries against."""

from __future__ import annotations

_MESSAGES = """
WITH messages AS (
  SELECT CASE WHEN event_type = 'error' THEN '__error' ELSE event_type END AS topic,
         CAST(user_id % 4 AS INT) AS partition,
         event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key,
         props AS value,
         ts AS timestamp
  FROM events
)
"""

_MIXED = """
WITH mixed AS (
  SELECT 'e' || event_id AS id, props AS value FROM events
  UNION ALL SELECT 'd' || doc_id, text FROM documents
  UNION ALL SELECT 'n' || n_nationkey, '["' || n_name || '"]' FROM nation
), classified AS (
  SELECT id, value,
         CASE WHEN NOT json_valid(value) THEN 'malformed'
              WHEN json_type(value) = 'OBJECT' THEN 'stored'
              ELSE 'not_document' END AS status
  FROM mixed
)
"""

_K = "CAST(json_extract_string({}, '$.k') AS BIGINT)"
_EVENT_K = f"SELECT event_id, {_K.format('props')} AS k FROM events"
_KPI = f"SELECT {_K.format('props')} AS k, count(*) AS count FROM events GROUP BY 1"
_LINES = (
    "SELECT {}unnest(string_split(text, chr(10))) || ' and hello spark' AS value FROM documents"
)
_ISO = "regexp_replace(strftime({}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')"

_JSON_ROWS = {
    "region": "json_object('r_regionkey', r_regionkey, 'r_name', r_name)",
    "nation": "json_object('n_nationkey', n_nationkey, 'n_name', n_name,"
    " 'n_regionkey', n_regionkey)",
    "customer": "json_object('c_custkey', c_custkey, 'c_name', c_name,"
    " 'c_nationkey', c_nationkey, 'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment)",
    "supplier": "json_object('s_suppkey', s_suppkey, 's_name', s_name,"
    " 's_nationkey', s_nationkey, 's_acctbal', s_acctbal)",
    "orders": "json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,"
    " 'o_orderstatus', o_orderstatus, 'o_totalprice', o_totalprice,"
    f" 'o_orderdate', {_ISO.format('o_orderdate')}, 'o_orderpriority', o_orderpriority)",
}
_PUBLISHED = " UNION ALL ".join(
    f"SELECT '{name}' AS source_table, CAST({row} AS VARCHAR) AS value FROM {name}"
    for name, row in _JSON_ROWS.items()
)
_LOG = 'topic, partition, "offset", key, value'

_PEEK = (
    f"{_MESSAGES} SELECT {_LOG} FROM messages"
    ' QUALIFY row_number() OVER (PARTITION BY topic ORDER BY partition, "offset") <= 6'
)


_WATCHED = (
    "SELECT o_orderkey, o_orderdate, CASE"
    " WHEN o_orderdate < TIMESTAMP '1995-06-17 00:00:00'"
    " OR (o_orderdate = TIMESTAMP '1995-06-17 00:00:00' AND o_orderkey <= 700) THEN 0"
    " WHEN o_orderdate < TIMESTAMP '1998-03-01 00:00:00'"
    " OR (o_orderdate = TIMESTAMP '1998-03-01 00:00:00' AND o_orderkey <= 900) THEN 1"
    " ELSE 2 END AS poll FROM orders"
)


def oracle() -> dict[str, str]:
    return {
        "topic_envelope": f"{_MESSAGES} SELECT {_LOG}, timestamp FROM messages",
        "multi_topic_read": f"{_MESSAGES} SELECT {_LOG} FROM messages"
        " WHERE topic IN ('click', 'view')",
        "pattern_read": f"{_MESSAGES} SELECT {_LOG} FROM messages"
        " WHERE topic = 'click' OR topic LIKE '%up'",
        "replay_from_earliest": f"{_MESSAGES} SELECT {_LOG} FROM messages",
        "start_from_latest": f"{_MESSAGES} SELECT {_LOG} FROM messages"
        " WHERE timestamp >= TIMESTAMP '2024-01-15 00:00:00'",
        "table_scan": "SELECT * FROM customer",
        "qualified_scan": "SELECT * FROM customer",
        "paged_result_flatten": "SELECT * FROM customer",
        "build_result_pages": "SELECT * FROM orders",
        "text_line_suffix": _LINES.format("doc_id, "),
        "text_file_suffix": _LINES.format(""),
        "incremental_poll": "SELECT event_id, ts FROM events"
        " WHERE ts > TIMESTAMP '2024-01-15 00:00:00' ORDER BY ts, event_id LIMIT 3",
        "incremental_poll_all": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
        "hide_internal_columns": f"{_MESSAGES} SELECT {_K.format('value')} AS k"
        " FROM messages WHERE topic = 'click'",
        "topic_sql": f"{_MESSAGES} SELECT {_K.format('value')} AS k, count(*) AS n FROM messages"
        " WHERE topic IN ('click', 'view') GROUP BY 1",
        "internal_columns": f"{_MESSAGES} SELECT {_LOG}, timestamp, {_K.format('value')} AS k"
        " FROM messages WHERE topic = 'click'",
        "collection_scan": f"{_MESSAGES} SELECT value AS message FROM messages"
        " WHERE topic = 'click'",
        "document_scan": f"{_MESSAGES} SELECT {_K.format('value')} AS k"
        " FROM messages WHERE topic = 'click'",
        "decode_value": f'{_MESSAGES} SELECT topic, partition, "offset", value FROM messages',
        "append_suffix": f"{_MESSAGES} SELECT value || ' Hello Spark!' AS \"Result\""
        " FROM messages",
        "parse_json_struct": _EVENT_K,
        "infer_json_schema": _EVENT_K,
        "infer_open_keys": 'SELECT o_orderkey AS "order", CAST(o_custkey AS VARCHAR) AS customer,'
        " CAST(o_totalprice AS DOUBLE) AS price FROM orders",
        "flatten_struct": _EVENT_K,
        "parse_document": _EVENT_K,
        "classify_messages": f"{_MIXED} SELECT id, status FROM classified",
        "row_to_json_array": "SELECT '[' || c_custkey || ', \"' || c_name || '\", ' || c_nationkey"
        " || ', ' || c_acctbal || ', \"' || c_mktsegment || '\"]' AS value FROM customer",
        "row_to_json_object": f"SELECT CAST({_JSON_ROWS['orders']} AS VARCHAR) AS value"
        " FROM orders",
        "iso_timestamps": f"SELECT event_id, {_ISO.format('ts')} AS ts_iso FROM events",
        "iso_instants": f"SELECT event_id, {_ISO.format('ts')} || '+00:00' AS at FROM events",
        "iso_nested_times": f"SELECT event_id, {_ISO.format('ts')} AS ts,"
        " strftime(ts, '%Y-%m-%dT00:00:00') AS day FROM events",
        "wrap_document": f"{_MESSAGES} SELECT topic, value AS message FROM messages",
        "row_cells": "SELECT c_custkey, unnest([0, 1, 2, 3, 4]) AS pos,"
        " unnest([CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),"
        " CAST(c_acctbal AS VARCHAR), c_mktsegment]) AS cell FROM customer",
        "text_serialise": "SELECT event_id, hex(encode(CAST(value AS VARCHAR))) AS bytes"
        " FROM events",
        "stream_rejected": f"{_MIXED} SELECT id, status, value AS raw FROM classified"
        " WHERE status <> 'stored'",
        "stream_typed_table": f"{_MESSAGES} SELECT topic, {_K.format('value')} AS k FROM messages",
        "stream_typed_drift": "WITH e AS (SELECT event_id % 5 AS kind,"
        " json_extract_string(props, '$.k') AS x FROM events) SELECT"
        " CASE WHEN kind IN (0, 2) THEN CAST(x AS BIGINT) END AS k,"
        " CASE kind WHEN 1 THEN '{\"k\":\"x' || x || '\"}' WHEN 2 THEN '{\"extra\":1,\"k\":' || x || '}'"
        " WHEN 3 THEN '{\"K\":' || x || '}' END AS rest,"
        " CASE kind WHEN 4 THEN 'malformed' ELSE 'stored' END AS status,"
        " CASE kind WHEN 4 THEN 'junk ' || x END AS raw FROM e",
        "document_scan_text": f"{_MESSAGES} SELECT {_K.format('value')} AS k"
        " FROM messages WHERE topic = 'click'",
        "stream_interval": f"{_MESSAGES} SELECT {_LOG} FROM messages",
        "topic_copy": f"{_MESSAGES} SELECT {_LOG} FROM messages",
        "kpi_count": _KPI,
        "stream_kpi": _KPI,
        "stream_running_kpi": _KPI,
        "stream_expiring_kpi": _KPI,
        "route_by_topic": f"{_MESSAGES} SELECT topic, count(*) AS n FROM messages GROUP BY topic",
        "list_topics": f"{_MESSAGES} SELECT DISTINCT topic FROM messages"
        " WHERE NOT starts_with(topic, '__')",
        "topic_catalog": f"{_MESSAGES} SELECT DISTINCT topic FROM messages"
        " WHERE NOT starts_with(topic, '__')",
        "topic_partitions": f"{_MESSAGES} SELECT topic,"
        " array_to_string(list_sort(list(DISTINCT partition)), ',') AS partitions,"
        " count(*) AS n_messages FROM messages GROUP BY topic",
        "topic_peek_stored": _PEEK,
        "topic_peek": _PEEK,
        "high_water_mark": "SELECT max(ts) AS last_check_time FROM events",
        "last_position": "SELECT o_orderdate, o_orderkey FROM orders"
        " ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
        "tables_to_topic": _PUBLISHED,
        "produced_row_count": f"SELECT source_table, count(*) AS n FROM ({_PUBLISHED})"
        " GROUP BY source_table",
        "published_messages": f"SELECT value FROM ({_PUBLISHED})",
        "stream_quarantine": f"{_MIXED} SELECT id, status,"
        " CASE WHEN status = 'stored' THEN '' ELSE value END AS raw FROM classified",
        "stream_fan_out": f"{_MESSAGES} SELECT topic, {_K.format('value')} AS k FROM messages"
        " WHERE topic IN ('click', 'view')",
        "delivery_report": f"{_MESSAGES} SELECT topic, partition, 'stored' AS status,"
        " count(*) AS count FROM messages GROUP BY topic, partition",
        "watched_table_nulls": "SELECT limited, o_orderkey,"
        " CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END AS o_orderdate"
        " FROM orders, (VALUES (false), (true)) AS modes(limited)",
        "watched_table": _WATCHED,
        "watched_stream": _WATCHED,
        "late_rows": "SELECT o_orderkey, o_orderdate, CASE"
        " WHEN o_orderkey % 4 > 0 AND o_orderdate < TIMESTAMP '1995-06-01' THEN 0"
        " WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1 ELSE 2 END AS poll FROM orders"
        " WHERE o_orderkey % 4 > 0 OR o_orderdate >= TIMESTAMP '1995-05-01'",
        "page_order": "WITH p AS (SELECT DISTINCT o_orderkey // 500 AS i FROM orders)"
        " SELECT 'whole' AS pages, i, row_number() OVER (ORDER BY i) - 1 AS page, 'complete' AS state FROM p"
        " UNION ALL SELECT 'gap', i, row_number() OVER (PARTITION BY i > 7 ORDER BY i) - 1,"
        " CASE WHEN i < 7 AND (SELECT max(i) FROM p) >= 7 THEN 'gap' ELSE 'complete' END FROM p WHERE i <> 7",
        "delivery_log": "SELECT count(*) AS messages, count(*) FILTER (user_id % 4 = 3) AS failed FROM events",
    }
