"""Removal of byte strings that occur more than once, by external induced sorting.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts elsewhere,
in the same document or another; strings are judged on the input.

The corpus is cut so that equal strings always meet in one shard:

1. Each string of ``LENGTH`` bytes has an anchor: of all ``GRAM``-byte substrings
   in it the one with the least hash, the leftmost at equal hashes.  It depends
   on the string alone.  Neighbouring strings with the same anchor form a block;
   a document has about ``2 / (LENGTH - GRAM)`` blocks per byte.
2. Blocks with equal content are one from here on, with a count.  Where an
   anchor has one content only, the count decides for the whole block.
3. Contents that share an anchor go to one shard as texts between separators.
   Their suffixes are ordered by external induced sorting with disk-backed
   queues that carry common-prefix values (``induced_sort``); a string repeats if
   its suffix shares ``LENGTH`` bytes with a neighbour.  A large anchor is split by
   the distance from the string's start to the anchor, which equal strings share.
   An anchor with so many contents that a single distance would exceed a shard is
   not sorted: its strings are counted by digest, with partial sums, so no task
   holds the strings of the anchor or the copies of one string.
4. The repeated ranges go back to all blocks of the content, and per document
   are joined into spans.

Defined results: null and empty texts have no bytes and no spans; texts shorter
than ``LENGTH`` stay whole; repeated rows remove each other's text; a null
``doc_id`` is a document like any other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices
from tidemark.llm.induced_sort import suffixes

LENGTH = 400
GRAM = 100
#: Bytes that a shard should have, and from which an anchor is split.
SHARD = 2 << 20
#: Bytes of a document that are hashed at once.
PIECE = 1 << 20
SEPARATOR = b"\xff"  # never part of UTF-8
_FACTOR = 0x9E3779B97F4A7C15
_PLACE_BITS = 24
#: A block's distance and count share a number, ten bits each, below its first string.
_FIELD = 10
_MASK = (1 << _FIELD) - 1


#: What tells contents of blocks apart.
_CONTENT = ("anchor", "content", "distance", "count")


def _row_key() -> list:
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2")]


class Anchors:
    """Rolling hashes of the substrings of a text and the blocks they cut."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.window = length, gram, length - gram + 1
        if not 0 < self.window <= _MASK:
            raise ValueError(f"length - gram lies between 0 and {_MASK - 1}")
        n = PIECE + 2 * length
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n, _FACTOR, np.uint64)])
            inverse = np.uint64(pow(_FACTOR, -1, 1 << 64))
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)])

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(data)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
            h = (sums[self.gram :] - sums[: -self.gram]) * self.inverses[: n - self.gram + 1]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
        # The place in the low bits makes the leftmost of equal hashes the least.
        least = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step * 2 <= self.window:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if self.window > step:
            least = np.minimum(least[: step - self.window], least[self.window - step :])
        starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place = (least[starts] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        return starts, np.diff(np.r_[starts, len(least)]), place, h[place].view(np.int64)

    def blocks(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First string, number of strings, anchor's distance from the first, anchor of each block."""
        data = np.frombuffer(text, np.uint8)
        found = []
        for at in range(0, max(len(data) - self.length + 1, 0), PIECE):
            piece = data[at : at + PIECE + self.length - 1]
            starts, counts, place, anchor = self._piece(piece)
            found.append((starts + at, counts, place - starts, anchor))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def blocks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Blocks of all rows: row key, place (first string, distance, count), anchor and a hash of the content.

    Rows are kept narrow, as there is one for some 150 bytes of text.  Content,
    anchor, distance and count together tell contents apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Anchors(length, gram)
        for batch in slices(batches):
            made = []
            for k1, k2, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first, count, distance, anchor = cutter.blocks(text or b"")
                if not len(first):
                    continue
                view = memoryview(text)
                content = [
                    xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(first, first + count + (length - 1), strict=True)
                ]
                place = first << 2 * _FIELD | distance << _FIELD | count
                n = len(first)
                made.append((np.full(n, k1), np.full(n, k2), place, anchor, np.array(content, np.uint64).view(np.int64)))
            if made:
                columns = [np.concatenate(c) for c in zip(*made, strict=True)]
                kinds = [np.int64, np.int32, np.int64, np.int64, np.int64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)],
                    ["k1", "k2", "place", "anchor", "content"],
                )

    return docs.select(*_row_key(), F.col("text").cast("binary")).mapInArrow(
        run, "k1 long, k2 int, place long, anchor long, content long"
    )


def shared_blocks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The blocks whose anchor occurs more than once; the others cannot hold a repeated string."""
    # Blocks are made twice rather than kept: there is one for some 150 bytes of text.
    found = blocks(docs, length, gram)
    # A cut point, so that the join shuffles both sides and can split a hot anchor.
    often = cut(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    place = F.col("place")
    return cut(
        found.join(often, "anchor").select(
            "k1",
            "k2",
            F.shiftright(place, 2 * _FIELD).alias("first"),
            F.shiftright(place, _FIELD).bitwiseAND(F.lit(_MASK)).cast("int").alias("distance"),
            place.bitwiseAND(F.lit(_MASK)).cast("int").alias("count"),
            "anchor",
            "content",
        )
    )


def _repeats(texts: list[bytes], strings: list[int], length: int) -> list[tuple[int, int, int]]:
    """(text, first, end) of the strings of ``length`` bytes that begin more than once in ``texts``."""
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    repeated = np.zeros(offsets[-1] + 1, bool)
    before = None
    for positions, prefix in suffixes(SEPARATOR.join(texts), length):
        hit = prefix >= length
        if before is not None and hit[0]:
            repeated[before] = True
        repeated[positions[hit]] = True
        repeated[positions[:-1][hit[1:]]] = True
        before = positions[-1]
    found = []
    for i, (at, n) in enumerate(zip(offsets, strings, strict=False)):
        flags = np.r_[False, repeated[at : at + n], False].astype(np.int8)
        change = np.diff(flags)
        found += [(i, int(s), int(e)) for s, e in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1), strict=True)]
    return found


def _counted(holders: DataFrame, length: int) -> DataFrame:
    """Ranges of strings that repeat in the blocks ``wanted`` of each ``text``, by counting digests of strings."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in slices(batches):
            for text, blocks_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                view = memoryview(text)
                for at in range(0, len(blocks_), 500):
                    rows = []
                    for b in blocks_[at : at + 500]:
                        content = [b[c] for c in _CONTENT]
                        for i in range(b["count"]):
                            s = b["first"] + i
                            rows.append((*content, i, hashlib.sha256(view[s : s + length]).digest()[:16]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        [*_CONTENT, "low", "digest"],
                    )

    # Digests are made twice rather than kept, as there is one for each string.
    made = holders.mapInArrow(digests, "anchor long, content long, distance int, count int, low int, digest binary")
    often = cut(made.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    # Strings in a row are one range.
    run = F.col("low") - F.row_number().over(Window.partitionBy(*_CONTENT).orderBy("low"))
    return (
        made.join(often, "digest")
        .select(*_CONTENT, "low", run.alias("run"))
        .groupBy(*_CONTENT, "run")
        .agg(F.min("low").alias("low"), (F.max("low") + 1).alias("high"))
        .drop("run")
    )


def repeated_contents(
    docs: DataFrame, found: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD
) -> DataFrame:
    """Ranges ``low`` to ``high`` of strings, counted from the block's first, that repeat: one row per content and range."""
    rep = F.min(F.struct("k1", "k2", "first")).alias("rep")
    contents = found.groupBy("anchor", "content", "distance", "count").agg(F.count(F.lit(1)).alias("copies"), rep)
    anchors = cut(
        contents.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("kinds"), F.sum(F.col("count") + (length - 1)).alias("bytes")
        )
    )
    known = cut(contents.join(anchors, "anchor"))
    whole = known.filter("copies > 1").select(
        *_CONTENT, F.lit(0).alias("low"), F.col("count").alias("high")
    )
    mixed = known.filter("kinds > 1")
    # A content has at most one string at each distance.
    hot = F.col("kinds") * length > shard
    totals = mixed.agg(F.sum(F.when(~hot, F.col("count") + (length - 1))), F.max(hot)).first()
    size, any_hot = totals[0] or 0, bool(totals[1])
    spark = docs.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // shard))
    # Strings of an anchor with many contents are dealt by their distance to it.
    window = length - gram + 1
    parts = F.least(F.ceil(F.col("bytes") / shard), F.lit(window)).cast("int").alias("parts")
    texts = docs.select(*_row_key(), F.col("text").cast("binary").alias("text"))

    def holders(some: DataFrame) -> DataFrame:
        wanted = (
            some.select("rep.k1", "rep.k2", F.struct("rep.first", *_CONTENT, parts).alias("b"))
            .groupBy("k1", "k2")
            .agg(F.collect_list("b").alias("wanted"))
        )
        # Rows that are equal share their key and hold the same text: one of them goes on.
        return texts.join(wanted, ["k1", "k2"]).groupBy("k1", "k2").agg(
            F.first("text").alias("text"), F.first("wanted").alias("wanted")
        ).select("text", "wanted")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", *_CONTENT, "low", "strings", "bytes"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in slices(batches):
            for text, blocks_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for b in blocks_:
                    step = -(-window // b["parts"])
                    at = 0
                    while at < b["count"]:  # the distance falls by one with each string
                        part = (b["distance"] - at) // step
                        end = min(b["count"], b["distance"] - part * step + 1)
                        s = b["first"] + at
                        content = [b[c] for c in _CONTENT]
                        rows.append((part, *content, at, end - at, text[s : s + end - at + length - 1]))
                        at = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents_, lows, strings, texts_ = [], [], [], []
        for batch in batches:
            contents_ += zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True)
            lows += batch.column(4).to_pylist()
            strings += batch.column(5).to_pylist()
            texts_ += batch.column(6).to_pylist()
        if not texts_:
            return
        rows = [(*contents_[i], lows[i] + s, lows[i] + e) for i, s, e in _repeats(texts_, strings, length)]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*_CONTENT, "low", "high"]
        )

    kind = "anchor long, content long, distance int, count int"
    dealt = (
        holders(mixed.filter(~hot)).mapInArrow(extract, f"part int, {kind}, low int, strings int, bytes binary")
        .repartition(shards, "anchor", "part")
        .select(*_CONTENT, "low", "strings", "bytes")
    )
    ordered = dealt.mapInArrow(order, f"{kind}, low int, high int")
    ranges = whole.unionByName(ordered)
    return ranges.unionByName(_counted(holders(mixed.filter(hot)), length)) if any_hot else ranges


def _joined(found: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and the spans of each text: its ranges (``found``), in order, joined where they meet."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            made = []
            for ranges in batch.column(2).to_pylist():
                merged: list[list[int]] = []
                for x in ranges:
                    if merged and x["s"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x["e"])
                    else:
                        merged.append([x["s"], x["e"]])
                made.append([{"start": s, "end": e} for s, e in merged])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, kind)], ["k1", "k2", "spans"])

    return found.select("k1", "k2", F.sort_array("found")).mapInArrow(
        merge, "k1 long, k2 int, spans array<struct<start:long,end:long>>"
    )


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``text`` as bytes and the spans (``start``, ``end``) to remove, in order, of every row."""
    source = docs.select("doc_id", "text")
    found = shared_blocks(source, length, gram)
    ranges = repeated_contents(source, found, length, gram, shard)
    ranges_ = (
        found.join(ranges, list(_CONTENT))
        .groupBy("k1", "k2")
        .agg(
            F.collect_set(
                F.struct((F.col("first") + F.col("low")).alias("s"), (F.col("first") + F.col("high") + (length - 1)).alias("e"))
            ).alias("found")
        )
    )
    # Spans are made before the texts come in: a stage with two Python steps keeps twice the workers, for good.
    return (
        source.select("doc_id", *_row_key(), F.col("text").cast("binary").alias("text"))
        .join(_joined(ranges_), ["k1", "k2"], "left")
        .select("doc_id", "text", F.coalesce("spans", F.array()).alias("spans"))
    )


def kept_bytes(text: bytes, spans: list[dict]) -> bytes:
    """``text`` without its spans."""
    edges = [0, *[x for s in spans for x in (s["start"], s["end"])], len(text)]
    return b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))


def digest(found: DataFrame) -> DataFrame:
    """Counts of a ``dedup`` result and the SHA-256 of what is kept."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or b""
                kept = kept_bytes(text, spans)
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return found.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
