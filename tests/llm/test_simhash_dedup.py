import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash_dedup as s
from tidemark.llm.queries import op10_simhash_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return 0
    parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Row -> (fingerprint, smallest id of its component)."""
    prints = [plain(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group, strict=True)]


def key(row):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in row)


def test_query(spark, sf_dir, corpus):
    found = sorted(tuple(r) for r in op10_simhash_dedup(spark, sf_dir).collect())
    assert found == sorted(brute([(r["doc_id"], r["text"]) for r in corpus.collect()]))


def test_hash_is_the_one_of_spark(spark):
    text = "naïve 東京 words"
    own = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()["h"]
    assert own % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover_every_difference(radius):
    masks = [m % (1 << 64) for m in s.masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    chance = random.Random(radius)
    for _ in range(3000):
        difference = sum(1 << b for b in chance.sample(range(64), radius))
        assert any(difference & m == 0 for m in masks)


@pytest.mark.parametrize("block", [4096, 3])
def test_links_join_exactly_what_is_near(spark, block):
    chance = random.Random(1)
    prints = set()
    for _ in range(12):
        centre = chance.getrandbits(64)
        for _ in range(15):
            x = centre
            for bit in chance.sample(range(64), chance.randrange(5)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = s.links(nodes, 3, block).collect()
    group = {p: p for p in prints}

    def join(a, b):
        old, new = max(group[a], group[b]), min(group[a], group[b])
        for p in group:
            group[p] = new if group[p] == old else group[p]

    for r in found:
        assert ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 3
        join(r["a"], r["b"])
    linked = dict(group)
    group.update({p: p for p in prints})
    for a, b in itertools.combinations(prints, 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= 3:
            join(a, b)
    assert linked == group


def test_roots_of_long_paths(spark):
    chance = random.Random(2)
    order = list(range(200))
    chance.shuffle(order)
    edges = list(zip(order, order[1:], strict=False)) + [(500, 501), (501, 502), (500, 502), (600, 600)]
    found = {r["node"]: r["root"] for r in s.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(200)}, 500: 500, 501: 500, 502: 500}
    assert s.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    found = s.components(odd).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert sorted(map(key, found)) == sorted(map(key, brute(rows)))
    kept = s.near_dedup(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    heads = {c for _, _, c in brute(rows) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(heads)
    assert ids.count(None) == 1
    assert s.components(none).count() == 0 and s.near_dedup(none).count() == 0


def test_one_row_of_each_component(spark):
    text, other = "one two three four", "five six seven eight nine"
    rows = [(1, text, "x"), (5, text, "x"), (5, other, "x"), (None, text, "x"), (None, other, "x"), (5, other, "y")]
    rows += [(None, "ten eleven twelve", "x"), (None, "ten eleven twelve", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__head` string")
    for part in (1, 4):
        found = sorted((r["text"], r["doc_id"]) for r in s.near_dedup(docs.repartition(part)).collect())
        assert found == [("five six seven eight nine", 5), ("one two three four", 1), ("ten eleven twelve", None)]
    assert s.near_dedup(docs).collect() == s.near_dedup(docs.repartition(3)).collect()
