"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints of 64 bits link at ``radius`` or fewer differing bits.  Bit ``i``
gets the vector ``i mod 2^(radius+1)``; for every nonzero vector ``v`` of
``radius + 1`` bits there is a table whose mask holds the bits with an odd
inner product with ``v``.  The vectors of at most ``radius`` differing bits
never span the whole space, so some ``v`` is orthogonal to all of them and its
mask avoids every difference: each linked pair meets in at least one of the
``2^(radius+1) - 1`` tables (15 for radius 3), and no pair is lost.

Equal fingerprints are one node.  Within a bucket only a spanning forest of the
links is emitted, never all pairs.  A bucket beyond ``block`` fingerprints is
dealt out as pairs of bounded blocks that are compared apart, so no task holds
a whole hot bucket and no link is dropped.

Defined results: a null or empty text has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows link; a null
``doc_id`` never names a component (its rows get the smallest id they reach,
null if there is none); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, packed, planned_once, slices

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Fingerprints of a bucket that one task compares at once.
BLOCK = 4096
_CHUNK = 1 << 16
#: Links that one task of the search for components gets, about.
LINKS_PER_TASK = 1 << 17
#: So many links, 16 bytes each, are followed to their ends in one task.
LINKS_AT_ONCE = 1 << 19


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one UTF-8 text, unsigned."""
    # bytes.lower and bytes.split know ASCII letters and the six white-space characters only.
    found = text.lower().split()
    if not found:
        return 0
    size = min(shingle, len(found))
    windows = zip(*[found[i:] for i in range(size)], strict=False)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(w), SEED) for w in windows), dtype=np.uint64, count=len(found) - size + 1
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the signed 64-bit fingerprint ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            signed = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """The masks of the tables, as signed 64-bit numbers."""
    vectors = 1 << (radius + 1)
    found = []
    for v in range(1, vectors):
        mask = sum(1 << i for i in range(BITS) if bin(v & (i % vectors)).count("1") % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _forest(found: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius: at most one fewer than the fingerprints."""
    found = found.view(np.uint64)  # the bits of a signed number are counted without its sign
    if len(found) == 2:
        near = int(np.bitwise_count(found[0] ^ found[1])) <= radius
        return [(0, 1)] if near else []
    label = np.arange(len(found))
    links = []
    for i in range(len(found) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(found[i + 1 :] ^ found[i]) <= radius)
        near = near[label[near] != label[i]]
        if len(near):
            others, first = np.unique(label[near], return_index=True)
            links += [(i, int(j)) for j in near[first]]
            label[np.isin(label, others)] = label[i]
    return links


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``a < b`` between distinct fingerprints ``fp``: a forest of each bucket."""
    tables = [
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(masks(radius))
    ]
    bucket = Window.partitionBy("t", "k")
    met = (
        nodes.select("fp", F.explode(F.array(*tables)).alias("x"))
        .select("fp", "x.t", "x.k")
        .withColumn("n", F.count(F.lit(1)).over(bucket))
        .filter("n > 1")
    )
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = met.select(
        "fp", "t", "k", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    ).select(
        "fp", "t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    dealt = dealt.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] | None = None  # the group that the next batch may continue

        def close(group: np.ndarray) -> list[tuple[int, int]]:
            return [(int(group[a]), int(group[b])) for a, b in _forest(group, radius)] if len(group) > 1 else []

        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.int64)
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (1, 2, 3, 4)])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
            found = []
            for s, e in zip(starts, np.r_[starts[1:], len(fp)], strict=True):
                key = tuple(keys[:, s])
                if left is not None and left[0] == key:
                    left[1].append(fp[s:e])
                    continue
                if left is not None:
                    found += close(np.concatenate(left[1]))
                left = [key, [fp[s:e]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())],
                ["a", "b"],
            )
        if left is not None:
            found = close(np.concatenate(left[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())],
                ["a", "b"],
            )

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _least(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))  # nodes are in order, so the least place is the smallest node
    while len(a):
        low, high = np.minimum(up[a], up[b]), np.maximum(up[a], up[b])
        np.minimum.at(up, high, low)
        while True:
            further = up[up]
            if (further == up).all():
                break
            up = further
        left = up[a] != up[b]
        a, b = a[left], b[left]
    return nodes, nodes[up]


def roots(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node ``root`` of its component, for every node with a link.

    Up to ``LINKS_AT_ONCE`` links are followed in one task.  More are dealt out, and two steps
    alternate until nothing changes or so few are left: every node hands its larger
    neighbours its smallest one, then its smaller neighbours.  Each round cuts
    the lineage; the number of rounds grows with the logarithm of the longest
    path, and links only become fewer.  The number of tasks goes by links, as few
    links dealt to many tasks cost jobs, files and memory of the driver only.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if parts:
            found = _least(*[np.concatenate(c) for c in zip(*parts, strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["node", "root"])

    # A link is (u, v) with u > v.
    pairs = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    # Few links need no shuffle, also where some come twice.
    with planned_once(pairs.sparkSession):
        few = pairs.count() <= LINKS_AT_ONCE
    if few:
        return pairs.coalesce(1).mapInArrow(follow, "node long, root long")
    pairs = cut(pairs.distinct())
    state = (0, None)
    while True:
        row = pairs.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if row["n"] <= LINKS_AT_ONCE:
            return pairs.select("u", "v").coalesce(1).mapInArrow(follow, "node long, root long")
        pairs = pairs.coalesce(row["n"] // LINKS_PER_TASK + 1)
        if (row["n"], row["h"]) == state:
            break
        state = (row["n"], row["h"])
        both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")
        both = pairs.select(both).select("x.*")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*")
            .filter("u <> v")
            .distinct()
        )
        pairs = cut(small)
    own = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), "v"))).alias("x")
    return pairs.select(own).groupBy(F.col("x.u").alias("node")).agg(F.min("x.v").alias("root"))


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest ``doc_id`` reachable) of every row."""
    rows = cut(fingerprints(docs, shingle))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("id")))
    found = roots(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component.

    It is the one with the smallest ``doc_id`` (null last); of rows that share it, the
    one with the smallest hash of its text and then of the whole row.
    """
    key = F.xxhash64(F.col("text").cast("binary"))
    texts = docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "text")
    rows = cut(fingerprints(texts, shingle)).select("doc_id.doc_id", "doc_id.key", "fp")
    found = roots(links(cut(rows.select("fp").distinct()), radius)).withColumnRenamed("node", "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    heads = (
        rows.join(found, "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min(order).alias("head"))
        .select(F.col("head.doc_id").alias("__head"), F.col("head.key").alias("__head_key"))
    )
    mine = packed(docs, F.col("doc_id").alias("__id"), key.alias("__key"))
    kept = mine.join(heads, (F.col("__key") == F.col("__head_key")) & F.col("__id").eqNullSafe(F.col("__head")))
    whole = F.xxhash64(F.to_json("__packed"))
    one = kept.groupBy("__id", "__key").agg(F.min_by("__packed", whole).alias("__packed"))
    return one.select("__packed.*")
