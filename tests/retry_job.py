"""Run by test_retries.py: every other task dies once, after it has produced rows."""

import sys

from pyspark import TaskContext
from pyspark.sql import functions as F

from tidemark.operators import TableWatch, infer_schema, kpi_count, only_documents
from tidemark.session import build_session
from tidemark.sources import (
    TopicSource,
    append_topic,
    flatten_pages,
    read_documents,
    read_topic,
    result_pages,
)
from tidemark.streaming import kpi_per_batch, read_kpi_store, store_documents

ROWS = 20_000


def dying(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
        if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
            raise RuntimeError("lost on purpose")


def main(folder):
    spark = build_session(
        "retries", "local[4,4]", {"spark.sql.shuffle.partitions": "6", "spark.checkpoint.dir": folder}
    )
    spark.sparkContext.setLogLevel("OFF")
    plain = spark.range(0, ROWS, 1, 8).select(
        "id", F.concat(F.lit('{"k":'), F.col("id") % 7, F.lit("}")).alias("value")
    )
    # A shuffle below and a dying step above whatever is under test.
    shaky = plain.repartition(8).mapInArrow(dying, plain.schema)

    append_topic(shaky.select("value", F.col("id").alias("key")), f"{folder}/log", "t", 3)
    append_topic(shaky.select("value", F.col("id").alias("key")), f"{folder}/log", "t", 3)
    log = read_topic(spark, TopicSource(("t",), format="parquet", path=f"{folder}/log"))
    assert log.count() == 2 * ROWS
    assert log.groupBy("key").count().where("count <> 2").isEmpty()

    flat = flatten_pages(result_pages(shaky, 100), plain.schema)
    assert flat.exceptAll(plain).isEmpty() and plain.exceptAll(flat).isEmpty()

    store_documents(shaky.withColumn("topic", F.lit("t")), f"{folder}/docs", rebalance=True)
    assert read_documents(spark, f"{folder}/docs").where("status = 'stored'").count() == ROWS

    watch = TableWatch(spark, lambda: shaky, "id", "id", f"{folder}/out", f"{folder}/mark")
    assert [watch.advance(), watch.advance()] == [ROWS, 0]
    assert watch.seen().select("id").distinct().count() == ROWS == watch.seen().count()

    counts = kpi_count(
        only_documents(shaky).select(F.try_variant_get("doc", "$.k", "bigint").alias("k")), "k"
    )
    assert {r["k"]: r["count"] for r in counts.collect()} == {
        k: len(range(k, ROWS, 7)) for k in range(7)
    }
    schema = infer_schema(shaky)
    assert schema.simpleString() == "struct<k:bigint>"

    plain.write.parquet(f"{folder}/files")
    stream = spark.readStream.schema(plain.schema).parquet(f"{folder}/files")
    rows = stream.mapInArrow(dying, plain.schema).select((F.col("id") % 7).alias("k"))
    kpi_per_batch(rows, "k", store=f"{folder}/kpi", checkpoint=f"{folder}/ck").awaitTermination()
    assert read_kpi_store(spark, f"{folder}/kpi", schema, f"{folder}/ck").agg(F.sum("count")).first()[0] == ROWS
    spark.stop()
    print("all whole")


if __name__ == "__main__":
    main(sys.argv[1])
