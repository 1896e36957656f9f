"""The plans Spark makes of the operators are the ones meant for large tables."""

import pytest
from pyspark.sql import types as T

import __spark_entry__ as contract
from tidemark.operators import apply_schema, only_documents, parse_documents, parse_struct
from tidemark.operators.parsing import document_field
from tidemark.streaming import as_documents

K = T.StructType([T.StructField("k", T.LongType())])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


SCAN_TO_RESULT = [
    "append_suffix", "build_result_pages", "classify_messages", "flatten_struct",
    "hide_internal_columns", "incremental_poll_all", "iso_nested_times", "iso_timestamps",
    "parse_document", "parse_json_struct", "row_cells", "row_to_json_array", "row_to_json_object",
    "tables_to_topic", "text_line_suffix", "text_serialise", "wrap_document",
]


@pytest.mark.parametrize("name", SCAN_TO_RESULT)
def test_projections_do_not_shuffle(spark, sf_dir, name):
    plan = _plan(contract.queries()[name](spark, sf_dir))
    assert "Exchange" not in plan


@pytest.mark.parametrize(
    "name",
    ["kpi_count", "list_topics", "topic_partitions", "produced_row_count", "topic_envelope",
     "topic_peek", "high_water_mark", "last_position", "internal_columns"],
)
def test_nothing_pairs_all_rows_or_runs_in_python(spark, sf_dir, name):
    plan = _plan(contract.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["kpi_count", "list_topics", "topic_partitions", "wrap_document"])
def test_positions_are_only_computed_where_they_are_read(spark, sf_dir, name):
    assert "row_number" not in _plan(contract.queries()[name](spark, sf_dir))


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    assert "ReadSchema: struct<props:string>" in _plan(contract.queries()["kpi_count"](spark, sf_dir))
    listing = _plan(contract.queries()["list_topics"](spark, sf_dir))
    assert "ReadSchema: struct<event_type:string>" in listing
    mark = _plan(contract.queries()["high_water_mark"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in mark


def test_each_message_is_parsed_once(events):
    k = document_field("doc", "$.k", "bigint").alias("k")
    documents = only_documents(events, "props").select(k).groupBy("k").count()
    assert _plan(documents).count("parseJson") == 1
    assert _plan(parse_documents(events, "props").select("status", "doc")).count("parseJson") == 1
    stored = parse_documents(events, "props").where("status = 'stored' AND user_id > 5").select(k)
    assert _plan(stored).count("parseJson") == 1
    assert "PushedFilters: [IsNotNull(user_id), GreaterThan(user_id,5)]" in _plan(stored)
    fitting = _plan(parse_struct(events, K, "props", corrupt="bad").where("bad IS NULL"))
    assert fitting.count("from_json") == 1
    log = events.selectExpr("event_type AS topic", "CAST(props AS binary) AS value")
    assert _plan(as_documents(log)).count("parseJson") == 1
    # The typed parse; the others in its plan only run for messages it could not take whole.
    typed = _plan(apply_schema(events, K, "props").groupBy("k").count())
    assert typed.count("from_json(StructField(rows") == 1
    assert "- Filter" not in typed


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = _plan(contract.queries()["kpi_count"](spark, sf_dir))
    before = plan[plan.index("Exchange") :]
    assert "partial_count" in before


def test_limited_polls_keep_a_heap_per_task(spark, sf_dir):
    plan = _plan(contract.queries()["incremental_poll"](spark, sf_dir))
    assert "TakeOrderedAndProject(limit=3" in plan and "Exchange" not in plan


def test_collections_are_pruned_to_their_folder(spark, sf_dir):
    plan = _plan(contract.queries()["collection_scan"](spark, sf_dir))
    assert "(topic#" in plan.split("PartitionFilters: [")[1].split("]")[0] + "]"
    documents = _plan(contract.queries()["document_scan"](spark, sf_dir))
    filters = documents.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "status" in filters and "topic" in filters
