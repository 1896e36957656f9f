import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q
from tidemark.llm.queries import op5_quality_rules


def counts(text):
    """The base counts of one text, counted plainly."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    found = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered))
    return (*found, found[0] < 20 or 100 * found[4] > 30 * found[0])


def test_counts_of_the_corpus(spark, sf_dir, corpus):
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    for r in op5_quality_rules(spark, sf_dir).collect():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == counts(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_odd_texts(spark, odd):
    extra = spark.createDataFrame(
        [(100, "a b c d e f g h " * 5 + "x\nx\n\n x\nx"), (101, "a b c d e f g"), (102, "a\x0bb\x0cc\xa0d e"), (103, "##\n##\n|")],
        "doc_id long, text string",
    )
    for rows in (odd.select("doc_id", "text"), extra):
        for r in q.with_measures(rows).collect():
            got = tuple(r["__q"][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert got == counts(r["text"])[:5], r["doc_id"]


@pytest.mark.parametrize("n,p", [(10, 0.3), (400, 0.01), (100_000, 0.004)])
def test_binomial_tail(spark, n, p):
    ks = [0, 1, 2, min(n, 7), min(n, 300)]
    rows = spark.createDataFrame([(k, n) for k in ks], "k long, n long")
    found = rows.select("k", q.log_binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
    for r in found:
        exact = math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
            for i in range(r["k"] + 1)
        )
        assert math.isclose(math.exp(r["t"]), exact, rel_tol=1e-6)


def labelled(spark, n, symbols, lang="en"):
    """``n`` good documents; every ``1/symbols``-th has many symbols."""
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(i, words + ("".join(f" |{j}" for j in range(45)) if symbols and i % symbols == 0 else ""), lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def cutoffs(docs, **settings):
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    measured = q.with_measures(docs).drop("text")
    return {r["__lang"]: r["__c_symbols"] for r in q.certify(measured, labels, **settings).collect()}


def test_certificates(spark):
    clean, dirty = labelled(spark, 3000, 0), labelled(spark, 3000, 20)
    assert cutoffs(clean) == {"en": 0.1}  # nothing is lost at the strictest cutoff
    assert cutoffs(dirty)["en"] == 1.0  # one in twenty has 0.53 symbols a word and must stay
    assert cutoffs(labelled(spark, 100, 0)) == {}  # too few to certify anything
    both = clean.unionByName(dirty.withColumn("doc_id", F.col("doc_id") + 9000).withColumn("lang", F.lit(None).cast("string")))
    found = cutoffs(both)
    assert found["en"] == 0.1 and found[None] == 1.0


def test_false_rejections_stay_below_the_bound(spark):
    docs = labelled(spark, 4000, 400)  # 0.25 % of the good documents have symbols
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    lost = docs.count() - q.filter_quality(docs, labels).count()
    assert lost <= q.MAX_LOSS * docs.count()


def test_odd_rows(odd, none, no_labels):
    kept = q.filter_quality(odd, no_labels)
    assert kept.columns == odd.columns
    want = sorted(str(r["doc_id"]) for r in odd.collect() if not counts(r["text"])[5])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert q.filter_quality(none, no_labels).count() == 0
    labels = odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert q.filter_quality(odd, labels).count() == len(want)


def test_junk_goes(spark):
    good = labelled(spark, 3000, 0)
    junk = labelled(spark, 50, 1).withColumn("doc_id", F.col("doc_id") + 5000)
    labels = good.select("doc_id", F.lit(1).alias("quality"))
    kept = q.filter_quality(good.unionByName(junk), labels)
    assert kept.filter("doc_id < 5000").count() == 3000
    assert kept.filter("doc_id >= 5000").count() == 0


def plain_cutoffs(rows, max_loss=q.MAX_LOSS, delta=q.DELTA):
    """Certified cutoffs of each language by going along the path with exact sums."""
    held = {}
    for lang, values in rows:
        held.setdefault(lang, []).append(values)
    found = {}
    for lang, good in held.items():
        reached, n = {}, len(good)
        for rule, cutoff in q.PATH:
            trial = {**reached, rule: cutoff}
            k = sum(any(v[r] > c for r, c in trial.items()) for v in good)
            tail = sum(math.comb(n, i) * max_loss**i * (1 - max_loss) ** (n - i) for i in range(k + 1))
            if k > n * max_loss or tail > delta / len(held):
                break
            reached = trial
        found[lang] = reached
    return found


def test_path_against_exact_sums(spark):
    """Four languages with few labels each get the cutoffs of the last setting that holds."""
    rows, good = [], []
    for i in range(4 * 260):
        lang, part = ("en", "de", "fr", None)[i % 4], i // 4
        words = [f"w{i}x{j}" for j in range(40)]
        n_symbols = {"de": 30 if part % 130 == 0 else 0, "fr": 5 if part % 20 == 0 else 0}.get(lang, 0)
        n_bangs = 9 if lang is None and part % 9 == 0 else 0
        text = " ".join(words) + " " + "#" * n_symbols + "!" * n_bangs
        rows.append((i, text, lang))
        n = len(text.split())
        chars = sum(map(len, text.split()))
        good.append((lang, {"symbols": n_symbols / n, "bangs": n_bangs / n, "dup_lines": 0.0, "repeats": 0.0, "long_words": chars / n}))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = {r["__lang"]: r for r in q.certify(q.with_measures(docs).drop("text"), labels).collect()}
    want = {k: v for k, v in plain_cutoffs(good).items() if v}
    assert {k: {r: found[k][f"__c_{r}"] for r in q.GRID if found[k][f"__c_{r}"] is not None} for k in found} == want
    assert want["en"]["dup_lines"] == 0.05 and want["fr"]["symbols"] == 0.2 and want[None]["bangs"] == 0.3
    assert len(want) >= 3
