import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding


def places(rows, **settings):
    return [(r["shard"], r["slot"]) for r in sharding.shard(rows, **settings).select("shard", "slot").collect()]


def assert_dealt(found, shards):
    sizes = [sum(s == i for s, _ in found) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted(found) == sorted((s, n) for s in range(shards) for n in range(sizes[s]))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 17, 100, 1009])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", sharding.permute(F.col("id"), n).alias("p"))
    assert sorted(r["p"] for r in rows.collect()) == list(range(n))


def test_rows_are_shuffled(spark):
    rows = spark.range(5000).select(sharding.permute(F.col("id"), 5000).alias("p")).collect()
    rising = sum(a["p"] < b["p"] for a, b in zip(rows, rows[1:], strict=False))
    assert 2200 < rising < 2800


def test_place_depends_on_the_row_number_alone(corpus):
    a = sharding.shard(corpus.select("doc_id", "text")).select("doc_id", "shard", "slot").collect()
    b = sharding.shard(corpus.repartition(7)).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert_dealt([(r["shard"], r["slot"]) for r in a], sharding.SHARDS)
    numbered, total = sharding.number_rows(corpus.select("doc_id"), buckets=16)
    ids = sorted(r["doc_id"] for r in corpus.collect())
    assert total == len(ids)
    assert [r["doc_id"] for r in numbered.orderBy("__row").collect()] == ids
    assert [r["__row"] for r in numbered.orderBy("__row").collect()] == list(range(total))


def test_hot_and_null_keys(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("other"),
    )
    numbered, total = sharding.number_rows(rows, buckets=32)
    found = numbered.orderBy("__row").collect()
    assert [r["__row"] for r in found] == list(range(900)) and total == 900
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert_dealt(places(rows), 16)


def test_odd_rows(odd, none):
    assert_dealt(places(odd, shards=4), 4)
    others = [c for c in odd.columns if c != "Shard"]  # a column of that name is replaced
    assert sharding.shard(odd).columns == [*others, "shard", "slot"]
    assert places(none) == []
