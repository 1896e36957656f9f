"""Benchmark decontamination by SimHash of item-sized windows.

Texts are compared by their lower-cased words and weighted five-word shingles;
a shingle found in ``d`` benchmark items weighs ``1/d`` (one in no item weighs
0).  The similarity of a window to an item is the weight of the item's shingles
found in the window, repeats counted, over the weight of all of them; a window
of at least ``SIMILARITY`` contaminates its document.

1. A window that similar shares a shingle with the item.  Shingles of all
   documents meet those of the items by hash; each match places a window of the
   item's length in words, aligned with the item.
2. Equal windows are one from here on.  Each gets a 64-bit SimHash in which a
   shingle votes with the root of its weight, so the cosine of a window to an
   item is at least their common weight over the root of the product of both
   weights, however the weights are spread.
3. The fingerprint is cut into ``RADIUS + 1`` blocks.  Two fingerprints within
   the radius agree in a block, so an equi-join on (length, block, value) meets
   all of them; the Hamming distance is then checked.
4. A window that weighs more than the item holds shingles of other items that
   could outvote those of the item.  Such pairs do not rely on fingerprints: a
   similar window has one of the item's rarest shingles that together weigh more
   than may be missing, and an equi-join on these meets all of them.
5. Candidates are verified by the exact similarity on the shingles themselves.

At similarity 0.8 the fingerprints differ in 9 bits on average if the window
has no shingles of other items and in 13, with a deviation of 3, if it weighs as
much as the item; the radius of 23 lies three deviations above.

Defined results: a null or empty document has no window; items of fewer than
five words are no evidence and match nothing; repeated items count once,
repeated documents are reported once per ``doc_id``; a null ``doc_id`` or
``item_id`` is reported as null; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, packed, small, with_window_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BITS = 64
#: Weights are whole numbers, so sums do not depend on their order.
UNIT = 1_000_000
#: Rows that may be broadcast (a few dozen bytes each); larger tables are shuffled.
_ROWS_TO_BROADCAST = 500_000


def _lower_words() -> Column:
    return words(F.lower(F.col("text")))


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _shingles(frame: DataFrame, source: str, *keep: str) -> DataFrame:
    """Each distinct shingle ``s`` of the word array ``source`` and how often it occurs, ``tf``."""
    starts = F.sequence(F.lit(0), F.size(source) - SHINGLE)
    every = F.transform(starts, lambda i: F.array_join(F.slice(source, i + 1, F.lit(SHINGLE)), " "))
    return (
        frame.filter(F.size(source) >= SHINGLE)
        .select(*keep, F.explode(every).alias("s"))
        .groupBy(*keep, "s")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _simhash(weighted: DataFrame, *keep: str) -> DataFrame:
    """The fingerprint ``fp`` of each group of rows ``s``, ``tf``, ``weight``."""
    root = F.floor(F.sqrt(F.col("tf") * F.col("weight") * F.lit(float(UNIT)))).cast("long")
    hashed = weighted.withColumn("h", F.xxhash64("s")).withColumn("m", root)
    votes = [
        F.sum(F.when(F.shiftright("h", b).bitwiseAND(F.lit(1)) == 1, F.col("m")).otherwise(-F.col("m"))).alias(f"b{b}")
        for b in range(BITS)
    ]
    set_bits = [
        F.when(F.col(f"b{b}") > 0, F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b).cast("long")).otherwise(
            F.lit(0).cast("long")
        )
        for b in range(BITS)
    ]
    value = set_bits[0]
    for bit in set_bits[1:]:
        value = value.bitwiseOR(bit)
    return hashed.groupBy(*keep).agg(*votes).select(*keep, value.alias("fp"))


def _blocks(radius: int) -> Column:
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftright("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"),
            )
            for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )


class Items:
    """The benchmark, prepared once: shingles with weights, lengths, fingerprints."""

    def __init__(self, items: DataFrame):
        known = (
            items.select("item_id", "text").distinct()
            .withColumn("item", F.xxhash64("item_id", "text"))
            .withColumn("w", _lower_words())
            .filter(F.size("w") >= SHINGLE)
            .withColumn("length", F.size("w"))
        )
        known = cut(known.select("item", "item_id", "w", "length"))
        shingles = _shingles(known, "w", "item", "length")
        self.weights = cut(
            shingles.groupBy("s").agg(F.floor(F.lit(UNIT) / F.count(F.lit(1))).cast("long").alias("weight"))
        )
        self.shingles = cut(shingles.join(self.weights, "s"))
        self.totals = self.shingles.groupBy("item").agg(F.sum(F.col("tf") * F.col("weight")).alias("whole"))
        self.fingerprints = cut(_simhash(self.shingles, "item", "length"))
        self.names = known.select("item", "item_id")
        hashed = with_window_hashes(known, "w", "g", SHINGLE)
        self.places = cut(
            hashed.select("length", F.posexplode(F.slice("g", F.lit(1), F.size("g"))).alias("offset", "g")).distinct()
        )


def candidate_windows(docs: DataFrame, items: Items) -> DataFrame:
    """Row key, first word and length of each window that shares an aligned shingle with an item."""
    hashed = with_window_hashes(
        docs.select(_row_key().alias("row"), _lower_words().alias("w")), "w", "g", SHINGLE
    )
    # Not a plain column: Spark would push a filter on it down and hash every text again.
    every = F.posexplode(F.slice("g", F.lit(1), F.size("g")))
    found = hashed.select("row", F.size("w").alias("n"), every.alias("at", "g"))
    # The spare shingles of a document meet the items in the task that reads it.
    met = found.join(small(items.places, _ROWS_TO_BROADCAST), "g")
    start = F.greatest(F.least(F.col("at") - F.col("offset"), F.col("n") - F.col("length")), F.lit(0))
    return met.select("row", start.alias("start"), "length").distinct()


def _rarest(known: Items, similarity: float) -> DataFrame:
    """The rarest shingles of each item: without any of them a window is not similar enough."""
    before = (
        Window.partitionBy("item").orderBy(F.desc("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        known.shingles.withColumn("before", F.coalesce(F.sum(F.col("tf") * F.col("weight")).over(before), F.lit(0)))
        .join(known.totals, "item")
        .filter(F.col("before") <= F.col("whole") * (1 - similarity) + 1)
        .select("item", "length", "whole", "s")
    )


def contaminated(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """Similar windows: ``row``, ``doc_id``, ``item_id``, ``start`` (word), ``length``, ``similarity``."""
    known = Items(items)
    windows = cut(candidate_windows(docs, known))
    texts = docs.select("doc_id", "text", _row_key().alias("row")).join(small(windows, _ROWS_TO_BROADCAST), "row")
    placed = texts.select(
        "row", "doc_id", "start", "length", F.slice(_lower_words(), F.col("start") + 1, F.col("length")).alias("w")
    ).withColumn("content", F.sha2(F.array_join("w", " "), 256))
    placed = cut(placed.distinct())
    contents = placed.groupBy("content", "length").agg(F.first("w").alias("w"))
    # Shingles of no item weigh nothing.
    shingles = cut(
        _shingles(contents, "w", "content", "length").join(small(known.weights, _ROWS_TO_BROADCAST), "s")
    )
    ours = _simhash(shingles, "content", "length")
    theirs = known.fingerprints.select(
        "item", "length", F.col("fp").alias("fp2"), F.explode(_blocks(radius)).alias("x")
    )
    theirs = cut(theirs.select("item", "length", "fp2", "x.block", "x.value"))
    pairs = (
        ours.select("content", "length", "fp", F.explode(_blocks(radius)).alias("x"))
        .select("content", "length", "fp", "x.block", "x.value")
        .join(small(theirs, _ROWS_TO_BROADCAST), ["length", "block", "value"])
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius)
        .select("content", "length", "item")
    )
    seen = shingles.groupBy("content", "length").agg(F.sum(F.col("tf") * F.col("weight")).alias("seen"))
    crowded = (
        shingles.select("content", "length", "s")
        .join(seen, ["content", "length"])
        .join(small(cut(_rarest(known, similarity)), _ROWS_TO_BROADCAST), ["length", "s"])
        .filter("seen > whole")
        .select("content", "length", "item")
    )
    shared = (
        pairs.unionByName(crowded)
        .distinct()
        .join(shingles.select("content", "length", "s", "tf"), ["content", "length"])
        .join(
            small(known.shingles.select("item", "s", F.col("tf").alias("tf2"), "weight"), _ROWS_TO_BROADCAST),
            ["item", "s"],
        )
        .groupBy("content", "length", "item")
        .agg(F.sum(F.least("tf", "tf2") * F.col("weight")).alias("shared"))
        .join(known.totals, "item")
        .withColumn("similarity", F.col("shared") / F.col("whole"))
        .filter(F.col("similarity") >= similarity)
    )
    hits = shared.join(known.names, "item").select("content", "length", "item_id", "similarity")
    return placed.select("row", "doc_id", "start", "length", "content").join(hits, ["content", "length"]).drop("content")


def report(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The best window of each contaminated document and item."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("at"), F.col("length").alias("n"))).alias("b")
    return (
        contaminated(docs, items, **settings)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            (-F.col("b.at")).cast("long").alias("start_word"),
            F.col("b.n").alias("n_words"),
            F.round("b.similarity", 6).alias("similarity"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without a window similar to an item."""
    rows = cut(contaminated(docs, items, **settings).select(F.col("row").alias("__row")).distinct())
    marked = packed(docs, _row_key().alias("__key"))
    clean = marked.join(small(rows, _ROWS_TO_BROADCAST), marked["__key"] == rows["__row"], "left_anti")
    return clean.select("__packed.*")
