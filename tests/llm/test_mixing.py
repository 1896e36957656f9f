import re

from pyspark.sql import functions as F

from tidemark.llm import mixing


def level(totals):
    """Targets by resharing the excess until no source is above its bound."""
    weights = [mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i in range(len(totals))]
    full, whole = set(), mixing.SHARE * sum(totals)
    while True:
        rest = whole - sum(mixing.MOST * totals[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        found = [mixing.MOST * t if i in full else rest * w / weight for i, (t, w) in enumerate(zip(totals, weights, strict=True))]
        over = {i for i, t in enumerate(totals) if i not in full and found[i] > mixing.MOST * t}
        if not over:
            return found
        full |= over


def test_targets(spark):
    for totals in ([10, 20, 30], [1000, 1, 1, 1], [1, 1000, 5, 7, 9, 11, 2], [0, 50, 60], [8]):
        rows = [(f"={i:02d}", t) for i, t in enumerate(totals)]
        found = mixing.targets(spark.createDataFrame(rows, "__source string, __total long")).orderBy("__source").collect()
        for r, want in zip(found, level(totals), strict=True):
            assert abs(r["__target"] - want) < 1e-6, totals


def taken(docs):
    mixed = mixing.mix(docs)
    size = F.size(mixing.words(F.col("text")))
    return {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(size).alias("n")).collect()}


def test_corpus(corpus):
    sizes = {r["source"]: 0 for r in corpus.collect()}
    longest = dict(sizes)
    for r in corpus.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        sizes[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    names = sorted(sizes)
    want = dict(zip(names, level([sizes[n] for n in names]), strict=True))
    found = taken(corpus)
    for name in names:
        # The sample stops at the document whose middle lies nearest before the mark.
        assert abs(found.get(name, 0) - want[name]) <= longest[name] / 2 + 1e-6
    again = mixing.mix(corpus.repartition(5)).groupBy("doc_id").count().collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixing.mix(corpus).groupBy("doc_id").count().collect()))
    assert max(r["count"] for r in again) <= 2


def test_level(spark):
    """Expected words are those missing; classes that would be above certainty stop there."""
    for extra, words in ((100.0, {1: 50, 3: 60, 5: 70}), (170.0, {1: 50, 3: 60, 5: 70}), (7.0, {4: 9}), (66.0, {2: 0, 9: 60, 10: 8})):
        rows = [("=a", extra, x, n) for x, n in words.items()]
        sums = spark.createDataFrame(rows, "__source string, __extra double, __x int, __sum long")
        (found,) = mixing.levels(sums).collect()
        expected = sum(n * min(1, found["__level"] * x) for x, n in words.items())
        assert abs(expected - extra) < 1e-6


def _copies(docs, seed):
    drawn = docs.select(*mixing.draw(docs, seed))
    return mixing.with_copies(drawn, mixing.plan_mix(drawn))


def test_inclusion_follows_the_odds(spark):
    """Over 200 seeds, each a source of its own, documents are taken as often as their odds say."""
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_repeat(F.lit("w"), F.element_at(F.array(F.lit(2), F.lit(8), F.lit(40)), (F.col("id") % 3 + 1).cast("int"))), " ").alias("text"),
    )
    seeds = spark.range(200).select(F.format_string("%03d", "id").alias("source"))
    many = docs.join(seeds).withColumn("doc_id", F.col("doc_id") * 1000 + F.col("source").cast("long"))
    # All sources weigh the same here: half of the words of each is drawn.
    drawn = many.select(*mixing.draw(many, 3))
    plan = mixing.plan_mix(drawn, weights=(1,), share=0.5)
    found = mixing.with_copies(drawn, plan).groupBy("__size").agg(F.avg("__copies").alias("often")).collect()
    level = plan.first()["__level"]
    for r in found:
        want = min(1, level * r["__size"].bit_length())
        assert abs(r["often"] - want) < 0.04, (r, want)
    assert len({round(r["often"], 1) for r in found}) == 3


def test_equal_rows_are_split_at_the_mark(spark):
    """A source of one text in 1000 equal rows meets its target."""
    rows = [(5, "four words of text", "b", str(i)) for i in range(1000)] + [(i, f"x{i} y z", "a", "") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more string").repartition(7)
    want = dict(zip("ab", level([3600, 4000]), strict=True))
    found = taken(docs)
    assert abs(found["b"] - want["b"]) <= 2 and abs(found["a"] - want["a"]) <= 2
    copies = mixing.mix(docs).filter("source = 'b'").groupBy("more").count().collect()
    assert max(r["count"] for r in copies) <= 2
    assert sorted(map(tuple, _copies(docs, 7).groupBy("__source", "__copies").count().collect())) == sorted(
        map(tuple, _copies(docs.repartition(3), 7).groupBy("__source", "__copies").count().collect())
    )


def test_odd_rows(odd, none):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    ids = {r["doc_id"] for r in odd.collect()}
    assert {r["doc_id"] for r in mixed.collect()} <= ids
    assert mixing.mix(none).count() == 0
    assert mixing.mix(odd.filter("doc_id in (6, 7, 8)")).count() == 0  # no words, no target
