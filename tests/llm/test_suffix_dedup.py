import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import induced_sort, suffix_dedup
from tidemark.llm.queries import op6_suffix_dedup


def common(a, b, most):
    n = 0
    while n < min(most, len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(8))
def test_suffix_order(seed, monkeypatch):
    chance = random.Random(seed)
    for trial in range(120):
        n, letters = chance.choice([1, 2, 3, 7, 40, 200]), chance.choice([1, 2, 3, 26])
        text = bytes(97 + chance.randrange(letters) for _ in range(n))
        if trial % 3 == 0:
            text = (text[:7] * 40)[:n] + text
        if trial % 5 == 0:
            text = text.replace(b"a", suffix_dedup.SEPARATOR)
        monkeypatch.setattr(induced_sort, "CHUNK", chance.choice([1, 3, 1 << 20]))
        depth, memory = chance.choice([3, 8, 20, 1000]), chance.choice([40, 1 << 20])  # 40: queues go to disk
        parts = list(induced_sort.suffixes(text, depth, memory))
        order = np.concatenate([p for p, _ in parts])[::-1]
        shared = np.concatenate([v for _, v in parts])[::-1]
        assert sorted(order) == list(range(len(text)))
        keys = [text[i : i + depth] for i in order]
        assert keys == sorted(keys)
        assert list(shared[:-1]) == [common(text[a:], text[b:], depth) for a, b in zip(order, order[1:], strict=False)]


def brute(texts, length):
    """Kept bytes, removed count and spans of each text."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    found = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        found.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return found


def run(frame, **settings):
    rows = suffix_dedup.digest(suffix_dedup.dedup(frame, **settings)).collect()
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), *tuple(r)[1:]) for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed, monkeypatch):
    chance = random.Random(seed)
    passages = ["".join(chance.choice("abcd ") for _ in range(chance.randrange(10, 120))) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [chance.choice(passages) if chance.random() < 0.5 else "".join(chance.choice("abcdefghij") for _ in range(30)) for _ in range(4)]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 150), (101, "x" * 200), (102, "ab" * 40), (103, None), (104, ""), (105, rows[0][1]), (None, rows[1][1]), (105, rows[0][1])]
    if seed % 2:
        monkeypatch.setattr(suffix_dedup, "PIECE", 64)  # documents are hashed in several pieces
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [(t or "").encode() for _, t in rows]
    want = sorted(((i is not None, i or 0), *f) for (i, _), f in zip(rows, brute(texts, 40), strict=True))
    # A shard of 500 bytes splits anchors with many contents by distance.
    for shard in (1 << 20, 500):
        assert run(frame, length=40, gram=10, shard=shard) == want


@pytest.mark.parametrize("shared", [32, 50])
def test_a_passage_in_many_surroundings(spark, shared, monkeypatch):
    """A passage shorter or longer than a string, in distinct surroundings: no task may get a string of each."""
    chance = random.Random(shared)

    def letters(n):
        return "".join(chance.choice("abcdefghij") for _ in range(n))

    passage = letters(shared)
    rows = [(i, letters(30) + passage + letters(30)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    most = spark.sparkContext.accumulator(0)
    read = suffix_dedup._repeats

    def spied(texts, strings, length):
        most.add(sum(map(len, texts)) > 4 * 2000)
        return read(texts, strings, length)

    monkeypatch.setattr(suffix_dedup, "_repeats", spied)
    want = sorted(((True, i), *f) for (i, _), f in zip(rows, brute([t.encode() for _, t in rows], 40), strict=True))
    assert run(frame, length=40, gram=10, shard=2000) == want
    assert most.value == 0  # some anchors share a task, but none brings all its contents


def test_query(spark, sf_dir, corpus):
    found = {r["doc_id"]: tuple(r)[1:] for r in op6_suffix_dedup(spark, sf_dir).collect()}
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in corpus.collect()]
    assert found == {i: f for (i, _), f in zip(rows, brute([t for _, t in rows], 400), strict=True)}


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in odd.select("doc_id", "text").collect()]
    want = sorted(((i is not None, i or 0), *f) for (i, _), f in zip(rows, brute([t for _, t in rows], 400), strict=True))
    assert run(odd) == want
    assert run(none) == []


def test_a_stage_has_one_python_step(odd):
    """Two in one stage would keep twice the workers in each executor, in all later stages too."""
    plan = suffix_dedup.digest(suffix_dedup.dedup(odd))._jdf.queryExecution().executedPlan().toString()
    stages = plan.split("Exchange")
    assert sum(s.count("MapInArrow") for s in stages) >= 2
    assert max(s.count("MapInArrow") for s in stages) == 1
