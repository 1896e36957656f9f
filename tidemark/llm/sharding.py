"""Reproducible shuffle into shards by a permutation of global row numbers.

Rows are numbered 0 to n-1 in the order of a key.  A Feistel network permutes
the numbers: ``n`` fits into a grid of ``a x b`` cells with ``a = ceil(sqrt n)``
and ``b = ceil(n / a)``, and rounds add a keyed hash of one coordinate to the
other, modulo its side.  Results outside ``n`` (fewer than ``a`` cells) are
encrypted again until they fall inside (cycle walking).  The place of a row is
then ``shard = p mod shards``, ``slot = p div shards``: computable from row
number, ``n`` and seed alone, gapless, and shard counts differ by one at most.

Numbering needs no global sort: approximate quantiles of the key split the rows
into ``buckets`` ranges, counts of the ranges give offsets, and each range is
numbered by itself.  A key value that fills several ranges is spread over them
by a hash of the row.  The result does not depend on the quantiles.

Defined results: null keys come first; equal keys follow in the order of a hash
of the other columns; wholly equal rows get different numbers; an empty table
gives no rows; columns ``shard`` and ``slot`` of the input are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed
from pyspark.sql import types as T

SHARDS = 16
SEED = 20_240
ROUNDS = 4
#: Ranges of the numbering; more only means smaller ranges.
BUCKETS = 1024
_UNHASHED = (T.MapType, T.VariantType)


def _bucket(key: Column, tie: Column, bounds: list) -> Column:
    """The range of a row: 0 up, in the order of the key; negative for null keys."""
    null = -1 - F.pmod(tie, F.lit(64))
    if not bounds:
        return F.when(key.isNull(), null).otherwise(F.lit(0).cast("long")).cast("int")
    places = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def below(test) -> Column:
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, step: F.when(test(F.get(places, at + step - 1)), at + step).otherwise(at),
        )

    least = below(lambda b: b < key)
    if len(set(bounds)) < len(bounds):
        many = F.greatest(below(lambda b: b <= key) - least, F.lit(1))
        least = least + F.pmod(tie, many)
    return F.when(key.isNull(), null).otherwise(least.cast("long")).cast("int")


def _tie(rows: DataFrame) -> Column:
    """A hash of all columns that have one."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema if not isinstance(f.dataType, _UNHASHED)])


def number_rows(
    rows: DataFrame, key: str = "doc_id", buckets: int = BUCKETS, tie: Column | None = None
) -> tuple[DataFrame, int]:
    """``rows`` with a gapless ``__row`` from 0 in the order of a numeric or time ``key``, and their count."""
    cells = [f"percentile_approx(`{key}`, array({', '.join(str(i / buckets) for i in range(1, buckets))}), {10 * buckets})"]
    found = rows.selectExpr(*cells).first()
    bounds = list(found[0] or []) if found else []
    tie = _tie(rows) if tie is None else tie
    placed = rows.withColumn("__bucket", _bucket(F.col(f"`{key}`"), tie, bounds))
    # At most one row per bucket comes to the driver.
    counts = sorted(tuple(r) for r in placed.groupBy("__bucket").count().collect())
    offsets, total = [], 0
    for bucket, count in counts:
        offsets.append((bucket, total))
        total += count
    table = rows.sparkSession.createDataFrame(offsets, "__bucket int, __offset long")
    order = Window.partitionBy("__bucket").orderBy(F.col(f"`{key}`"), tie)
    numbered = (
        placed.withColumn("__n", F.row_number().over(order))
        .join(F.broadcast(table), "__bucket")
        .withColumn("__row", F.col("__offset") + F.col("__n") - 1)
        .drop("__bucket", "__n", "__offset")
    )
    return numbered, total


def permute(row: Column, total: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The place of a row number under a permutation of 0 to ``total - 1``."""
    if total < 2:
        return row
    a = math.isqrt(total - 1) + 1
    b = -(-total // a)

    def mixed(x: Column, number: Column, modulus: int) -> Column:
        return F.pmod(F.xxhash64(x, number), F.lit(modulus).cast("long"))

    def step(state: Column, i: Column) -> Column:
        left = F.pmod(state["l"] + mixed(state["r"], 2 * i + seed, a), F.lit(a).cast("long"))
        right = F.pmod(state["r"] + mixed(left, 2 * i + 1 + seed, b), F.lit(b).cast("long"))
        return F.struct(left.alias("l"), right.alias("r"))

    def encrypt(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b).cast("long")).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["l"] * b + s["r"])

    place, outside = encrypt(row), a * b - total
    if not outside:
        return place
    # A walk visits every outside cell once at most, so `outside` steps always end it;
    # fewer than `a` rows walk at all.
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(outside)),
        place,
        lambda at, _: F.when(at < total, at).otherwise(encrypt(at)),
    )
    return F.when(place < total, place).otherwise(walked)


def shard(rows: DataFrame, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with the columns ``shard`` (int) and ``slot`` (long), which replace any of these names."""
    narrow = packed(rows, F.col(f"`{key}`").alias("__by"), _tie(rows).alias("__tie"))
    numbered, total = number_rows(narrow, "__by", tie=F.col("__tie"))
    placed = numbered.withColumn("__place", permute(F.col("__row"), total, seed))
    others = [F.col(f"__packed.`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")]
    return placed.select(
        *others,
        F.pmod("__place", F.lit(shards).cast("long")).cast("int").alias("shard"),
        F.floor(F.col("__place") / shards).cast("long").alias("slot"),
    )
