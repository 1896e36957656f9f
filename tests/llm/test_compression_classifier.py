import zlib

from pyspark.sql import functions as F

from tidemark.llm import compression_classifier as c
from tests.llm.conftest import sentence


def labelled(spark, n):
    """Good prose and bad lists of symbols."""
    rows = [(i, sentence(i, 80) if i % 3 else "### $$$ " + " | ".join(sentence(i, 60).upper().split())) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(1).alias("quality"))


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark, 900)
    found = c.score(docs, c.fit(docs, labels)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    tried = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 3 > 0) for r in tried)
    assert len(tried) > 100 and right / len(tried) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= c.THRESHOLD) for r in found)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(spark, 300)
    wrong = labels.withColumn("quality", F.when(c.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert c.fit(docs, labels) == c.fit(docs, wrong)


def test_corpus(spark, sf_dir, corpus):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = c.score(corpus, c.fit(corpus, labels)).join(labels, "doc_id").collect()
    good = [r["score"] for r in found if r["quality"] == 1]
    bad = [r["score"] for r in found if r["quality"] == 0]
    assert sum(good) / len(good) > sum(bad) / len(bad)


def test_odd_rows(spark, odd, none, no_labels):
    docs, labels = labelled(spark, 200)
    model = c.fit(docs, labels)
    found = c.score(odd, model)
    assert found.count() == odd.count()
    scores = {r["doc_id"]: r["score"] for r in found.collect()}
    assert scores[6] == scores[7] and all(0 <= s <= 1 for s in scores.values())
    assert not [r for r in found.collect() if r["doc_id"] is None and r["held_out"]]
    assert c.score(none, model).count() == 0
    assert {r["score"] for r in c.score(odd, c.fit(odd, no_labels)).collect()} == {0.5}
    one = odd.select("doc_id", F.lit(1).alias("quality"))
    assert c.score(odd, c.fit(odd, one)).first()["score"] > 0.99
    few = spark.createDataFrame([(1, 1), (4, 0), (99, 0), (None, 0)], "doc_id long, quality int")
    assert c.score(odd, c.fit(odd, few)).count() == odd.count()
