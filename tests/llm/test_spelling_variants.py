import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import spelling_variants as v
from tidemark.llm.queries import op13_spelling_variants

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = str.maketrans(UPPER, UPPER.lower())


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point lies between two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_near(words):
    """Near words of every word: those with a common deletion, then looked at."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def plain_variants(counts):
    near, rows = plain_near(counts), {}
    for w, n in counts.items():
        form = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if form is not None and counts[form] < 2 * n:
            form = None
        rows[w] = (w, form, None, n, len(near[w]), counts[form] if form else None)
    found = []
    for w, row in rows.items():
        root = w
        while rows[root][1]:
            root = rows[root][1]
        found.append((*row[:2], root, *row[3:]))
    return sorted(found)


def plain_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 5:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def test_query(spark, sf_dir, corpus):
    found = op13_spelling_variants(spark, sf_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_counts([(r["doc_id"], r["text"]) for r in corpus.collect()]))
    assert sorted(map(tuple, found.collect())) == want
    assert sum(r[1] is not None for r in want) > 5


def words_of(seed, n=400, letters="aabcé"):
    chance = random.Random(seed)
    return sorted({"".join(chance.choice(letters) for _ in range(chance.randint(0, 9))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(20))
def test_scan(seed):
    rests = words_of(seed)
    want = {(a, b) for a, b in itertools.combinations(range(len(rests)), 2) if one_edit(rests[a], rests[b])}
    found = list(v.scan(rests))
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("most", [v.MOST, 20, 1])
def test_large_groups_are_split(spark, most):
    chance = random.Random(7)
    counts = {w: chance.randint(1, 40) for w in words_of(3, 900, "ab") + words_of(4, 300, "aàÿz") if len(w) >= 2}
    # Many words with the same beginning or the same end.
    counts |= {f"inter{w}": 5 for w in words_of(5, 200, "abc") if w} | {f"{w}ation": 7 for w in words_of(6, 200, "abc") if w}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(map(tuple, v.variants(words, most=most).collect())) == plain_variants(counts)
    if most == 20:
        sizes = v._groups(words, most).filter("least > 1").groupBy("key").count()
        assert sizes.agg({"count": "max"}).first()[0] <= most


def test_long_chain_of_forms(spark):
    counts = {"b" * i + "a" * (70 - i): 3 * 2**i for i in range(40)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r["root"] for r in v.variants(words).collect()} == {"b" * 39 + "a" * 31}
    with pytest.raises(ValueError):
        v.variants(words, ratio=1)


def test_odd_rows(spark, odd, none):
    found = {r["word"]: r["n"] for r in v.vocabulary(odd, 2, 1).collect()}
    assert found["ab"] == 3000 and found["ÄÖÜ"] == 30 and found["naïve"] == 30 and found["stanbul"] == 30
    assert found["x" * 100_000] == 1
    rows = v.variants(v.vocabulary(odd, 1, 1)).collect()
    assert len(rows) == v.vocabulary(odd, 1, 1).count()
    assert v.variants(v.vocabulary(none)).count() == 0
    texts = spark.createDataFrame([(1, "Straße STRAßE straÿe ÀB×÷ àb×÷")], "doc_id long, text string")
    assert {r["word"] for r in v.vocabulary(texts, 1, 1).collect()} == {"straße", "straÿe", "Àb×÷", "àb×÷"}
