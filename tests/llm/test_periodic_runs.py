import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodic_runs as r
from tidemark.llm.queries import op11_periodic_runs


def plain_runs(words):
    """(start, length, period) of every run, found by trying all periods."""
    n, stretches = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or words[i] != words[i + q]:
                if i + q - start >= max(6, 4 * q):
                    stretches.setdefault((start, i + q), q)
                start = i + 1
    return sorted((s, e - s, q) for (s, e), q in stretches.items())


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text):
    words = planted(doc_id, text)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, sf_dir, corpus):
    found = op11_periodic_runs(spark, sf_dir)
    assert found.columns == COLUMNS
    got = {x["doc_id"]: tuple(x) for x in found.collect()}
    rows = corpus.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [x for x in rows if len((x["text"] or "").split()) < 3000]
    assert len(short) > 150
    for x in short:
        assert got[x["doc_id"]] == digest(x["doc_id"], x["text"])
    assert sum(x[1] > 0 for x in got.values()) > 10


def periodic(chance):
    """Numbers with runs of many periods, runs inside runs among them."""
    found = []
    for _ in range(chance.randint(1, 5)):
        inner = [chance.randint(0, 3) for _ in range(chance.randint(1, 6))] * chance.randint(1, 7)
        found += (inner + [chance.randint(0, 9) for _ in range(chance.randint(0, 3))]) * chance.randint(1, 6)
    return found


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_all_periods(seed):
    chance = random.Random(seed)
    texts = [[b"%d" % x for x in periodic(chance)] for _ in range(8)] + [[], [b"a"], [b"a"] * 40]
    found = r.runs_of_texts(texts)
    assert [[tuple(map(int, x)) for x in f] for f in found] == [plain_runs(t) for t in texts]


def test_places_are_extended_in_parts(monkeypatch):
    texts = [[b"a", b"b"] * 300, [b"x"] * 200]
    whole = r.runs_of_texts(texts)
    monkeypatch.setattr(r, "_PLACES", 5)
    assert all(np.array_equal(a, b) for a, b in zip(whole, r.runs_of_texts(texts), strict=True))


@pytest.mark.parametrize("seed", range(20))
def test_extensions(seed):
    chance = random.Random(seed)
    row = np.array(periodic(chance) + periodic(chance) + [99])
    grammar = r.Grammar(row)
    n = len(row)
    pairs = [sorted(chance.sample(range(n), 2)) for _ in range(200)]
    i, j = np.array(pairs).T
    ahead, back = grammar.extension(i, j), grammar.extension(i, j, back=True)
    for k, (x, y) in enumerate(pairs):
        assert ahead[k] == next(d for d in range(n) if y + d == n or row[x + d] != row[y + d])
        assert back[k] == next(d for d in range(n) if x - d == 0 or row[x - d - 1] != row[y - d - 1])


def test_grammar_of_a_long_repetition_is_small():
    row = np.tile(np.arange(50), 4000)
    assert len(r.Grammar(row).symbols) < 6 * len(row)
    assert r.runs(np.r_[row, 99], len(row)).tolist() == [[0, len(row), 50]]


def test_odd_rows(odd, none):
    found = {(x["doc_id"], x["n_words"]): x for x in r.collapse_runs(odd).collect()}
    assert found[(11, 3000)]["text"] == "ab" and [tuple(x) for x in found[(11, 3000)]["runs"]] == [(0, 3000, 1)]
    assert found[(6, 0)]["text"] == "" and found[(6, 0)]["runs"] == []
    assert found[(9, 20_000)]["runs"] == []
    assert r.collapse_runs(odd).count() == odd.count()
    assert r.collapse_runs(none).count() == 0
    assert r.collapse_runs(odd, words=1).count() == odd.count()  # a batch for each text
