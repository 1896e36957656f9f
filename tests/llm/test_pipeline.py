"""The pipeline, stage by stage against brute force."""

import re

import pytest

import corpus_pipeline
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_mixing import level
from tests.llm.test_quality_rules import counts
from tests.llm.test_simhash_dedup import brute as near
from tidemark.llm import mixing


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    """Documents, and what every stage made of them, as rows."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == found["documents"][0].__fields__
        made.write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        found[name] = docs.collect()
    return found


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_passages", "source_mix", "shards"]


def test_quality(results):
    # Too few labels at this size to certify a cutoff: the base rules decide.
    want = {r["doc_id"] for r in results["documents"] if not counts(r["text"])[5]}
    assert {r["doc_id"] for r in results["quality"]} == want


def test_near_duplicates(results):
    rows = [(r["doc_id"], r["text"]) for r in results["quality"]]
    assert sorted(r["doc_id"] for r in results["near_duplicates"]) == sorted({c for _, _, c in near(rows)})


def test_benchmark_passages(spark, sf_dir, results):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {i for i, _ in leaks([(r["doc_id"], r["text"]) for r in results["near_duplicates"]], items)}
    want = {r["doc_id"] for r in results["near_duplicates"]} - gone
    assert {r["doc_id"] for r in results["benchmark_passages"]} == want


def test_source_mix(results):
    def sizes(rows):
        found = {}
        for r in rows:
            found[r["source"]] = found.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        return found

    before, after = sizes(results["benchmark_passages"]), sizes(results["source_mix"])
    names = sorted(before)
    for name, want in zip(names, level([before[n] for n in names]), strict=True):
        longest = max(len(r["text"].split()) for r in results["benchmark_passages"] if r["source"] == name)
        assert abs(after.get(name, 0) - want) <= longest
    assert max(sum(r["doc_id"] == i for r in results["source_mix"]) for i in {r["doc_id"] for r in results["source_mix"]}) <= mixing.MOST


def test_shards(results):
    found = sorted((r["shard"], r["slot"]) for r in results["shards"])
    per = [sum(s == i for s, _ in found) for i in range(16)]
    assert found == [(s, n) for s in range(16) for n in range(per[s])] and max(per) - min(per) <= 1
    plain = sorted(tuple(r)[:-2] for r in results["shards"])
    assert plain == sorted(tuple(r) for r in results["source_mix"])


def test_run(spark, sf_dir, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, results["shards"]))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, sf_dir, odd, none, name, stage):
    extra = [] if name != "shards" else ["shard", "slot"]
    for docs in (odd, none):
        made = stage(spark, docs, sf_dir)
        kept = [c for c in docs.columns if not extra or c != "Shard"]  # replaced by the shard
        assert made.columns == [*kept, *extra]
        made.collect()
    assert stage(spark, none, sf_dir).count() == 0
