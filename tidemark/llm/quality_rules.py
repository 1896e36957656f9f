"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document whose measure lies above a cutoff.  A path of joint
settings of all rules is fixed in advance, from loose to strict: rule after rule,
each through its grid, so what a setting rejects the next ones reject as well.  The
labelled good documents are the holdout: for a stratum (the language) with ``n`` of
them, of which ``k`` would be rejected by any rule, a setting is certified when the exact binomial
upper bound of its false rejection rate is at most ``max_loss``, that is when
``P(X <= k | n, max_loss) <= delta / strata``.  The settings of a stratum are tested in
their order up to the first that fails, and the last certified one is used.  Such a
fixed sequence needs no correction for its length, and the one for the strata is
Bonferroni's, so with probability ``1 - delta`` the rules together reject at most
``max_loss`` of the good documents of every stratum.  With four strata 217 good
labels without a false rejection are enough; a stratum with too few gets no cutoff
and loses nothing.

Defined results: a null or empty text has no words and fails the base rules; a
null language is a stratum of its own; repeated rows are judged each; labels
without a document, and documents without a label, do not count; several labels
of one document count as the lowest; without labels only the base rules act;
further columns are carried along, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, packed, small, total, with_window_hashes, words

MIN_WORDS = 20
WINDOW = 8
#: Largest share of good documents the rules may reject, and the chance of a wrong certificate.
MAX_LOSS = 0.02
DELTA = 0.05
#: Fixed grids, from loose to strict, in the order in which the path goes through the rules.
GRID = {
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "bangs": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "dup_lines": (0.5, 0.3, 0.2, 0.1, 0.05),
    "repeats": (0.25, 0.2, 0.15, 0.1, 0.05),
    "long_words": (20.0, 16.0, 14.0, 12.0, 10.0),
}
#: Every step of the path tightens one rule.
PATH = tuple((rule, cutoff) for rule, grid in GRID.items() for cutoff in grid)
_STRATA_TO_BROADCAST = 10_000
_LABELS_TO_BROADCAST = 1_000_000


def with_measures(docs: DataFrame) -> DataFrame:
    """Add the struct ``__q`` of counts of each whole text to ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.size("__w")
    frame = docs.withColumn("__w", words(F.col("text")))
    frame = frame.withColumn(
        "__l", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    frame = with_window_hashes(frame, "__w", "__g", WINDOW)
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("__g")) < F.size("__g")
    frame = frame.withColumn(
        "__s",
        F.when(repeats, F.sort_array(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    m = F.size("__s")
    frame = frame.withColumn(
        "__p",
        F.when(
            F.col("__s").isNotNull(),
            F.sort_array(
                F.array_distinct(
                    F.flatten(
                        F.filter(
                            F.zip_with(
                                F.slice("__s", F.lit(1), m - 1),
                                F.slice("__s", F.lit(2), m - 1),
                                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
                            ),
                            lambda x: x.isNotNull(),
                        )
                    )
                )
            ),
        ),
    )
    k = F.size("__p")
    covered = F.when(
        F.col("__p").isNotNull(),
        F.aggregate(
            F.zip_with(
                F.slice("__p", F.lit(1), k - 1),
                F.slice("__p", F.lit(2), k - 1),
                lambda a, b: F.least(b - a, F.lit(WINDOW)),
            ),
            F.lit(WINDOW),
            lambda acc, x: acc + x,
        ),
    ).otherwise(F.lit(0))

    def count(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        count("!").cast("long").alias("n_bangs"),
    )
    # Out of a generator: a filter on a plain column would be pushed below the arrays,
    # and every one of them evaluated again wherever the filter mentions it.
    return frame.withColumn("__q", F.explode(F.array(counts))).drop("__w", "__l", "__g", "__s", "__p")


def base_failed() -> Column:
    q = F.col("__q")
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > 30 * q["n_words"])


def _measures() -> dict[str, Column]:
    q = F.col("__q")
    n = F.greatest(q["n_words"], F.lit(1)).cast("double")
    return {
        "symbols": q["n_symbols"] / n,
        "bangs": q["n_bangs"] / n,
        "dup_lines": q["n_dup_lines"] / F.greatest(q["n_lines"], F.lit(1)),
        "repeats": q["n_repeat_words"] / n,
        "long_words": q["word_chars"] / n,
    }


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, p), summed in logarithms."""
    first = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(state["sum"], term), F.least(state["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    start = F.struct(first.alias("term"), first.alias("sum"))
    return F.when(k <= 0, first).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), start, add, lambda s: s["sum"])
    )


def _good(labels: DataFrame) -> DataFrame:
    """``__id`` of the documents that are labelled good."""
    lowest = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__quality"))
    return lowest.filter("__quality = 1").select("__id")


def certify(
    measured: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS, delta: float = DELTA
) -> DataFrame:
    """One row per stratum ``__lang`` with the certified cutoff of each rule, null where none is."""
    values = _measures()
    # The first step of the path that rejects a document; the later ones do so as well.
    first = F.least(
        F.lit(len(PATH)), *[F.when(values[rule] > cutoff, F.lit(i)) for i, (rule, cutoff) in enumerate(PATH)]
    )
    rejected = [F.sum((F.col("__first") <= i).cast("long")).alias(f"r{i}") for i in range(len(PATH))]
    holdout = (
        measured.filter(~base_failed())
        .select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), first.alias("__first"))
        .join(_good(labels), "__id")
        .groupBy("__lang")
        .agg(F.count(F.lit(1)).alias("n"), *rejected)
    )
    holdout = cut(holdout)
    strata = max(holdout.count(), 1)
    allowed = math.log(delta / strata)
    steps = [F.struct(F.lit(i).alias("step"), F.col(f"r{i}").alias("k")) for i in range(len(PATH))]
    rows = holdout.select("__lang", "n", F.explode(F.array(*steps)).alias("t")).select("__lang", "n", "t.*")
    # Above the mean the tail is over a third at least and never certifies; it need not be summed.
    tail = F.when(F.col("k") <= F.col("n") * max_loss, log_binomial_tail(F.col("k"), F.col("n"), max_loss))
    failed = F.coalesce(tail > allowed, F.lit(True))
    reached = rows.groupBy("__lang").agg(
        F.coalesce(F.min(F.when(failed, F.col("step"))), F.lit(len(PATH))).alias("__reached")
    )
    cutoffs = []
    for rule in GRID:
        # The strictest of its cutoffs that the path passed, null before the first.
        passed = [F.when(F.col("__reached") > i, F.lit(c)) for i, (r, c) in enumerate(PATH) if r == rule]
        cutoffs.append(F.coalesce(*reversed(passed)).alias(f"__c_{rule}"))
    return cut(reached.filter("__reached > 0").select("__lang", *cutoffs))


def judge(
    docs: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS, delta: float = DELTA
) -> DataFrame:
    """``docs`` with ``__q`` (counts), ``__base_failed`` and ``__kept``."""
    # Only documents with a label count for the certificate, so the others are not measured for it.
    good = small(cut(_good(labels)), _LABELS_TO_BROADCAST).withColumnRenamed("__id", "doc_id")
    held = docs.select("doc_id", "lang", "text").join(good, "doc_id", "left_semi")
    return apply_cutoffs(with_measures(docs), certify(with_measures(held).drop("text"), labels, max_loss, delta))


def apply_cutoffs(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    bounds = small(cutoffs, _STRATA_TO_BROADCAST).alias("__b")
    joined = measured.alias("__m").join(bounds, F.col("__m.lang").eqNullSafe(F.col("__b.__lang")), "left")
    over = [
        F.coalesce((value > F.col(f"__c_{rule}")).cast("int"), F.lit(0)) for rule, value in _measures().items()
    ]
    return (
        joined.withColumn("__base_failed", base_failed())
        .withColumn("__kept", ~F.col("__base_failed") & (total(over) == 0))
        .drop("__lang", *[f"__c_{rule}" for rule in GRID])
    )


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    return judge(packed(docs, "doc_id", "lang", "text"), labels).filter("__kept").select("__packed.*")
