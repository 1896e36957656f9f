import random
import re
from collections import Counter

import pytest

from tests.llm.conftest import sentence
from tidemark.llm import decontamination as d


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return w, [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(docs, items):
    """(doc_id, item_id) with a window similar enough, over all windows of the item's length."""
    items = {(i, t) for i, t in items if len(shingles(t)[0]) >= 5}
    df = Counter(s for _, t in items for s in set(shingles(t)[1]))
    found = set()
    for item, text in items:
        words, parts = shingles(text)
        want = Counter(parts)
        whole = sum(n * (d.UNIT // df[s]) for s, n in want.items())
        for doc, body in docs:
            w, grams = shingles(body)
            if not set(grams) & set(want):
                continue
            for start in range(max(len(w) - len(words), 0) + 1):
                have = Counter(grams[start : start + len(words) - 4])
                if sum(min(n, have[s]) * (d.UNIT // df[s]) for s, n in want.items()) >= d.SIMILARITY * whole:
                    found.add((doc, item))
                    break
    return found


def pairs(frame):
    return {(r["doc_id"], r["item_id"]) for r in frame.collect()}


def test_corpus(spark, sf_dir, corpus):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in corpus.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    found = d.report(corpus, items)
    assert want and pairs(found) == want
    kept = {r["doc_id"] for r in d.decontaminate(corpus, items).collect()}
    assert kept == {r["doc_id"] for r in corpus.collect()} - {i for i, _ in want}


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_edited_passages(spark, broadcast, monkeypatch):
    monkeypatch.setattr(d, "_ROWS_TO_BROADCAST", broadcast)
    chance = random.Random(3)
    items = [(i, sentence(100 + i, 30 + i)) for i in range(12)] + [(50, "only four words here"), (51, None), (None, sentence(99, 40)), (0, sentence(100, 30))]
    docs = []
    for n in range(80):
        words = sentence(100 + n % 12, 30 + n % 12).split()
        for _ in range(n // 20):
            at = chance.randrange(len(words))
            words[at : at + 1] = chance.choice([["changed"], [], ["put", "in"]])
        docs.append((n, (sentence(n + 500, n) + " " + " ".join(words).upper() + "\n" + sentence(n + 900, 12)).strip()))
    docs += [(200, None), (200, ""), (201, sentence(100, 30)), (201, sentence(100, 30)), (None, sentence(101, 31)), (202, sentence(101, 10)), (203, sentence(99, 40))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len({i for i, _ in want}) > 30
    found = pairs(d.report(frame, bench))
    # Windows are aligned with a shared shingle, so a found pair is always right; an
    # edit may move the best window by a word and leave a borderline pair below.
    assert found <= want and len(want - found) <= 1


@pytest.mark.parametrize("copies", [2, 5, 10])
def test_edited_copies_of_items_that_share_text(spark, copies):
    chance = random.Random(copies)
    items, docs = [], []

    def add(words):
        docs.append((len(docs), f"{sentence(5000 + len(docs), 12)} {' '.join(words)} {sentence(7000 + len(docs), 12)}"))

    for n in range(6):
        text = sentence(100 + n, 29 + 4 * (n % 3)).split()
        items += [(100 * n + c, " ".join(text)) for c in range(copies)]  # the same text
        template = sentence(300 + n, 40).split()
        items += [(1000 + 100 * n + c, " ".join([f"case{n}x{c}", *template])) for c in range(copies)]  # another first word
        other = sentence(500 + n, 40).split()
        items.append((2000 + n, " ".join(other)))
        for _ in range(8):
            edited = list(text)
            edited[chance.randrange(len(text))] = "changed"
            add(edited)
            add(["changed", *template])
        # Its end is the beginning of an item of its own, whose shingles weigh more.
        add([*text[: len(text) - 3], *other[:3]])
        add([*text[: len(text) - 5], *other[:9]])
        add([*other[-8:], *text[3:]])
    want = brute(docs, items)
    assert len(want) > 100
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert pairs(d.report(frame, spark.createDataFrame(items, "item_id long, text string"))) == want


def test_blocks_meet_every_pair_within_the_radius(spark):
    chance = random.Random(5)
    rows = []
    for i in range(300):
        a = chance.getrandbits(64)
        b = a
        for bit in chance.sample(range(64), chance.randrange(d.RADIUS + 1)):
            b ^= 1 << bit
        rows.append((i, *[x - (1 << 64) if x >> 63 else x for x in (a, b)]))
    frame = spark.createDataFrame(rows, "i int, a long, b long")
    left = frame.select("i", frame["a"].alias("fp")).select("i", d._blocks(d.RADIUS).alias("x")).collect()
    right = frame.select("i", frame["b"].alias("fp")).select("i", d._blocks(d.RADIUS).alias("x")).collect()
    for x, y in zip(left, right, strict=True):
        assert set(x["x"]) & set(y["x"])


def test_odd_rows(spark, odd, none, no_items):
    items = spark.createDataFrame([(1, sentence(5)), (2, None), (3, ""), (4, sentence(9, 40))], "item_id long, text string")
    clean = d.decontaminate(odd, items)
    assert clean.columns == odd.columns
    gone = {r["doc_id"] for r in odd.collect()} - {r["doc_id"] for r in clean.collect()}
    assert gone == {None, 9}
    assert clean.count() == odd.count() - 2
    assert d.decontaminate(odd, no_items).count() == odd.count()
    assert d.decontaminate(none, items).count() == 0
    assert d.report(none, no_items).count() == 0
