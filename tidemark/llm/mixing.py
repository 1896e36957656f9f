"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words: shares of the whole by weight, cut at
``most`` times the size of the source, the excess shared again by weight.  A
source whose target is ``k + ratio`` times its size gives ``k`` certain whole copies
of each document.  The words still missing come from a Pareto order sample of unequal
odds: a document is included with probability ``f = min(1, level * x)``, where ``x`` is the
number of binary digits of its size (long documents are likelier than short ones) and the
``level`` of the source makes the expected words those that are missing.  Documents are
ranked by their random odds ``u / (1 - u)`` divided by the inclusion odds ``f / (1 - f)``,
and the lowest ranks are taken until the missing words are reached (the document
that crosses the mark is taken if its middle lies before it).

``u`` depends on seed, id and text only, so reruns agree.  The mark is found
without sorting a source: sums per (source, rank bucket) tell the bucket it lies
in, and only that bucket is sorted, rows of one rank as one.

Defined results: a null or empty text has size 0, a null source is a source of
its own and comes last; a source without words has target 0; rows that agree in
id and text share their draw, and if the mark lies among them as many are taken as it
needs; an empty table gives no rows; further columns are carried along, whatever
they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, packed, small, uniform, words

#: Weights of the sources in the order of their names, repeating; share of all words; largest repetition.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 7
BUCKETS = 1024
_SOURCES_TO_BROADCAST = 100_000
_NEARLY = 1e-9


def draw(docs: DataFrame, seed: int) -> list[Column]:
    """Source key (never null), size and random number of each row."""
    source = F.col("source")
    return [
        F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("__source"),
        F.size(words(F.col("text"))).cast("long").alias("__size"),
        uniform(F.lit(seed), F.col("doc_id"), F.md5(F.col("text").cast("binary"))).alias("__u"),
    ]


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sizes`` (``__source``, ``__total``) with the ``__target`` of each source.

    Sources are few against documents: one row each is sorted in one task.
    """
    order = Window.orderBy(F.col("__source") == "", "__source")
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.select(
        "__source", "__total", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("__w")
    ).withColumn("__cap", F.col("__total") * F.lit(most))
    # In the order in which sources fill up, the level is what is left over the weight that is left.
    filling = Window.orderBy(F.col("__cap") / F.col("__w"), "__source").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("__total").over(everything) * share - F.coalesce(F.sum("__cap").over(filling), F.lit(0.0))
    ) / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(filling), F.lit(0.0)))
    full = weighed.withColumn("__full", F.col("__cap") / F.col("__w") <= level)
    open_weight = F.sum(F.when(~F.col("__full"), F.col("__w"))).over(everything)
    left = F.sum("__total").over(everything) * share - F.coalesce(
        F.sum(F.when(F.col("__full"), F.col("__cap"))).over(everything), F.lit(0.0)
    )
    return full.select(
        "__source",
        "__total",
        F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("__w") * left / open_weight).alias("__target"),
    )


def _chance(level: Column, size: Column) -> Column:
    """The inclusion probability of a document beyond its certain copies."""
    return F.least(F.lit(1.0), level * F.length(F.bin(size)))


def _rank(chance: Column, u: Column) -> Column:
    """Pareto rank, mapped from (0, inf) to (0, 1) in the same order; certain documents have the lowest."""
    f = F.least(F.greatest(chance, F.lit(_NEARLY)), F.lit(1 - _NEARLY))
    odds = (u / (1 - u)) / (f / (1 - f))
    return odds / (1 + odds)


def levels(sums: DataFrame) -> DataFrame:
    """The ``__level`` of each source from ``sums`` (``__source``, ``__extra``, ``__x`` and words ``__sum``).

    Classes of the longest documents become certain first; the level is what is missing
    after those, over the rest.  A source has a row for each binary order of sizes.
    """
    order = Window.partitionBy("__source").orderBy(F.desc("__x"))
    longer = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("__extra") - F.coalesce(F.sum("__sum").over(longer), F.lit(0))) / F.sum(
        F.col("__x") * F.col("__sum")
    ).over(rest)
    open_ = sums.filter("__sum > 0").withColumn("__at", level).filter(F.col("__at") * F.col("__x") < 1)
    return open_.groupBy("__source").agg(F.max_by("__at", "__x").alias("__level"))


def plan_mix(drawn: DataFrame, **settings) -> DataFrame:
    """One row per source: ``__total``, ``__target``, ``__whole`` copies, the ``__level`` of further ones,
    the last rank taken (``__last``), and how many rows to take (``__take``) of those that have it (``__of``)."""
    classes = cut(
        drawn.groupBy("__source", F.length(F.bin("__size")).alias("__x")).agg(F.sum("__size").alias("__sum"))
    )
    sizes = classes.groupBy("__source").agg(F.sum("__sum").alias("__total"))
    found = targets(sizes, **settings)
    ratio = F.when(F.col("__total") > 0, F.col("__target") / F.col("__total")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + _NEARLY)
    found = cut(
        found.withColumn("__whole", whole.cast("int"))
        .withColumn("__ratio", ratio - whole)
        .withColumn("__extra", F.col("__target") - F.col("__whole") * F.col("__total"))
    )
    sampled = found.filter(F.col("__ratio") > _NEARLY).select("__source", "__extra")
    level = levels(classes.join(sampled, "__source"))
    sampled = cut(sampled.join(level, "__source"))
    ranked = drawn.join(small(sampled, _SOURCES_TO_BROADCAST), "__source").select(
        "__source", "__size", "__extra", _rank(_chance(F.col("__level"), F.col("__size")), F.col("__u")).alias("__rank")
    )
    ranked = ranked.withColumn("__bucket", F.floor(F.col("__rank") * BUCKETS).cast("int"))
    sums = ranked.groupBy("__source", "__bucket", "__extra").agg(F.sum("__size").alias("__sum"))
    upto = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    marked = cut(
        sums.withColumn("__before", F.coalesce(F.sum("__sum").over(upto), F.lit(0)))
        .filter(F.col("__before") < F.col("__extra"))
        .filter(F.col("__before") + F.col("__sum") >= F.col("__extra"))
        .groupBy("__source")
        .agg(F.min(F.struct("__bucket", "__before")).alias("__mark"))
        .select("__source", "__mark.*")
    )
    # Equal rows have one rank; they are counted before the bucket is sorted.
    equal = (
        ranked.join(small(marked, _SOURCES_TO_BROADCAST), ["__source", "__bucket"])
        .groupBy("__source", "__rank", "__size", "__before", "__extra")
        .agg(F.count(F.lit(1)).alias("__of"))
    )
    earlier = Window.partitionBy("__source").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)
    missing = (
        F.col("__extra") - F.col("__before") - F.coalesce(F.sum(F.col("__of") * F.col("__size")).over(earlier), F.lit(0))
    )
    # Row j of equal ones is taken if its middle, (j - 1/2) sizes on, lies before the mark.
    take = F.when(F.col("__size") > 0, F.ceil(missing / F.col("__size") + 0.5) - 1).otherwise(
        F.when(missing > 0, F.col("__of")).otherwise(0)
    )
    last = (
        equal.withColumn("__take", F.least(take, F.col("__of")))
        .filter("__take > 0")
        .groupBy("__source")
        .agg(F.max(F.struct("__rank", "__take", "__of")).alias("__end"))
        .select("__source", F.col("__end.__rank").alias("__last"), "__end.__take", "__end.__of")
    )
    # No rank of the marked bucket may be low enough: then all buckets before it are taken.
    floor = marked.select("__source", (F.col("__bucket") / F.lit(float(BUCKETS))).alias("__floor"))
    plan = found.join(level, "__source", "left").join(floor, "__source", "left").join(last, "__source", "left")
    return cut(plan.withColumn("__last", F.coalesce("__last", "__floor")).drop("__ratio", "__extra", "__floor"))


def with_copies(drawn: DataFrame, drawn_plan: DataFrame) -> DataFrame:
    """``drawn`` rows with ``__total``, ``__target`` and the number of ``__copies``."""
    joined = drawn.join(small(drawn_plan, _SOURCES_TO_BROADCAST), "__source")
    joined = joined.withColumn("__rank", _rank(_chance(F.col("__level"), F.col("__size")), F.col("__u")))
    taken = F.coalesce(F.col("__rank") <= F.col("__last"), F.lit(False)).cast("int")
    split = F.coalesce((F.col("__rank") == F.col("__last")) & (F.col("__take") < F.col("__of")), F.lit(False))
    plain = joined.withColumn("__copies", F.col("__whole") + taken)
    if drawn_plan.filter("__take < __of").isEmpty():
        return plain
    # The mark lies among equal rows: they are numbered by the partition they are in and their place there.
    equal = cut(joined.filter(split)).withColumn("__part", F.spark_partition_id())
    equal = equal.withColumn("__place", F.monotonically_increasing_id())
    parts = equal.groupBy("__source", "__part").count()
    upto = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(parts.select("__source", "__part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("__start")))
    place = F.row_number().over(Window.partitionBy("__source", "__part").orderBy("__place"))
    numbered = equal.withColumn("__place", place).join(starts, ["__source", "__part"])
    among = (F.col("__start") + F.col("__place") <= F.col("__take")).cast("int")
    numbered = numbered.withColumn("__copies", F.col("__whole") + among)
    return plain.filter(~split).unionByName(numbered.select(*plain.columns))


def mix(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """The mixed rows: those of ``docs``, each as often as it is taken."""
    drawn = cut(docs.select(*draw(docs, seed)))
    rows = packed(docs, *draw(docs, seed))
    copied = with_copies(rows, plan_mix(drawn, **settings))
    repeated = copied.withColumn("__again", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
    return repeated.select("__packed.*")
