"""Running counts whose state is given up when a group has been idle."""

from collections import Counter
from datetime import timedelta

from pyspark.sql import types as T

from tidemark.streaming import expiring_kpi, expiring_totals

FIELDS = T.StructType().add("k", T.StringType()).add("n", T.IntegerType())


def _run(spark, folder, idle):
    stream = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = expiring_kpi(stream, "k", "n", idle=idle, store=f"{folder}/kpi", checkpoint=f"{folder}/check")
    query.awaitTermination()
    found = expiring_totals(spark, f"{folder}/kpi", FIELDS, f"{folder}/check").collect()
    return query, Counter({(r["k"], r["n"]): r["count"] for r in found})


def _add(spark, folder, rows):
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_expired_groups_leave_the_state_and_totals_stay(spark, folder):
    """Every batch has groups of its own and two that come again and again, null among them."""
    every = Counter()
    for i in range(5):
        rows = [(f"only{i}-{j}", j) for j in range(30)] + [("hot", 1)] * 300 + [(None, None)] * 7
        every.update(rows)
        _add(spark, folder, rows)
    query, found = _run(spark, folder, timedelta(milliseconds=1))
    assert found == every
    states = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    per_group = states[0] / 32  # a value and its timer may be several rows
    assert max(states) <= 2 * 32 * per_group < 5 * 30 * per_group


def test_restart_goes_on(spark, folder):
    every = Counter()
    for _ in range(2):
        rows = [("a", 1), ("a", 1), ("b", None)]
        every.update(rows)
        _add(spark, folder, rows)
        _, found = _run(spark, folder, timedelta(hours=1))
        assert found == every
    stored = spark.read.parquet(f"{folder}/kpi/counts")
    assert stored.select("k", "since").distinct().count() == 2  # one count each, kept over the restart
