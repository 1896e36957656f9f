"""Token ids of documents in patched frame-of-reference blocks.

Format of a segment (little-endian)::

    magic "PFR1", block size u32, ids u64, blocks u32
    byte offset of each block from the first one, u32 each, and the end
    blocks: minimum u32, width u8, exceptions u32,
            ids minus minimum, packed at ``width`` bits, most significant first,
            positions u32 and values u32 of the exceptions

The width of a block is that of its ``PERCENTILE`` largest difference; larger
differences are exceptions, packed as 0 and patched from the list.  The offsets
let any range of ids be read without the blocks before it.

Segments hold whole documents in ascending order of ``doc_id`` and are rows of a
Parquet folder, so Spark's committer takes care of lost tasks.  A row also has the
ids and lengths of its documents and its place in its part; parts are ranges of
``doc_id``.

Defined results: a null or empty text is the end id alone; null ids come first;
equal ids follow each other in the order of their texts; an empty table gives an
empty folder with a schema; the strings of special tokens are the library's.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, slices, small

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 95
END = 0
#: Ids after which a segment is closed, and pieces of text that a task remembers.
SEGMENT = 1 << 18
MOST_WORDS = 600_000
_HEAD = 20
_SCHEMA = (
    "part int, segment int, part_start long, n_ids long, doc_ids array<{kind}>, lengths array<long>, payload binary"
)
_FILES_TO_BROADCAST = 500_000


# --- the format ------------------------------------------------------------


def _bits(values: np.ndarray) -> np.ndarray:
    """The number of bits of each value."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    ids = np.asarray(ids, dtype=np.uint32)
    count = -(-len(ids) // block)
    spare = count * block - len(ids)
    rows = np.concatenate([ids, np.full(spare, ids[-1] if len(ids) else 0, np.uint32)]).reshape(count, block)
    low = rows.min(axis=1) if count else np.zeros(0, np.uint32)
    rest = rows - low[:, None]
    place = min(block - 1, int(block * percentile / 100))
    width = _bits(np.partition(rest, place, axis=1)[:, place]) if count else np.zeros(0, np.int64)
    over = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        plain = np.where(over[at], 0, rest[at]).astype(">u4")
        if w and w % 8 == 0:  # whole bytes need no shifting
            body = plain.view(np.uint8).reshape(len(at), block, 4)[:, :, 4 - w // 8 :].reshape(len(at), -1)
        elif w:
            bits = np.unpackbits(plain.view(np.uint8).reshape(len(at), block, 4), axis=2)[:, :, 32 - w :]
            body = np.packbits(bits.reshape(len(at), -1), axis=1)
        else:
            body = np.zeros((len(at), 0), np.uint8)
        for i, b in zip(at, body, strict=True):
            where = np.flatnonzero(over[i]).astype("<u4")
            packed[i] = (
                int(low[i]).to_bytes(4, "little")
                + int(w).to_bytes(1, "little")
                + len(where).to_bytes(4, "little")
                + b.tobytes()
                + where.tobytes()
                + rest[i][where].astype("<u4").tobytes()
            )
    starts = np.cumsum([0] + [len(p) for p in packed]).astype("<u4")
    head = MAGIC + block.to_bytes(4, "little") + len(ids).to_bytes(8, "little") + count.to_bytes(4, "little")
    return b"".join([head, starts.tobytes(), *packed])


def unpack(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids ``start`` to ``stop``; only their blocks are read."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    block, count = int.from_bytes(data[4:8], "little"), int.from_bytes(data[16:20], "little")
    ids = int.from_bytes(data[8:16], "little")
    stop = ids if stop is None else min(stop, ids)
    if start >= stop:
        return np.zeros(0, np.uint32)
    offsets = np.frombuffer(data, "<u4", count + 1, _HEAD).astype(np.int64)
    base = _HEAD + 4 * (count + 1)
    first, last = start // block, (stop - 1) // block + 1
    heads = [base + int(o) for o in offsets[first:last]]
    widths = np.array([data[h + 4] for h in heads])
    rows = np.zeros((last - first, block), np.uint32)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        size = block * int(w) // 8 + (block * int(w) % 8 > 0)
        if w:
            raw = np.stack([np.frombuffer(data, np.uint8, size, heads[i] + 9) for i in at])
        if w and w % 8 == 0:
            whole = np.zeros((len(at), block, 4), np.uint8)
            whole[:, :, 4 - w // 8 :] = raw.reshape(len(at), block, w // 8)
            rows[at] = whole.view(">u4")[:, :, 0]
        elif w:
            bits = np.zeros((len(at), block, 32), np.uint8)
            bits[:, :, 32 - w :] = np.unpackbits(raw, axis=1)[:, : block * w].reshape(len(at), block, w)
            rows[at] = np.packbits(bits, axis=2).view(">u4")[:, :, 0]
        for i in at:
            patched = int.from_bytes(data[heads[i] + 5 : heads[i] + 9], "little")
            if patched:
                tail = heads[i] + 9 + size
                rows[i, np.frombuffer(data, "<u4", patched, tail)] = np.frombuffer(
                    data, "<u4", patched, tail + 4 * patched
                )
            rows[i] += np.uint32(int.from_bytes(data[heads[i] : heads[i] + 4], "little"))
    return rows.reshape(-1)[start - first * block : stop - first * block]


# --- texts to ids ----------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it prints, else the next from 256 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Known(dict):
    """The ids of pieces seen, bounded; an unknown piece is encoded."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if len(self) < self.most:
            self[piece] = found
        return found


class Encoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    Such a tokenizer never joins what stands on two sides of a single space
    between non-spaces (the space begins the next pre-token), of a single line
    break, or of a word and the punctuation marks after it.  Texts are cut there,
    and each distinct piece is encoded by the library once and remembered.
    """

    _cut = re.compile(r"(?<=\S)(?= \S)")
    _double = re.compile(r"\s\s")
    _marked = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")

    def __init__(self, tokenizer_file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.merges = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.spaced = _Known(lambda word: self._piece(" ", word), MOST_WORDS)  # with a space before it
        self.bare = _Known(lambda word: self._piece("", word), MOST_WORDS)

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, space: str, word: str) -> bytes:
        if word.isalpha():  # one pre-token: straight to the merges
            # ASCII letters stand for themselves.
            own = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            return array("I", [t.id for t in self.merges(self.space + own if space else own)]).tobytes()
        known = self.spaced if space else self.bare
        marked = self._marked.fullmatch(word)
        if marked and marked[1].isalpha():
            return known[marked[1]] + self.bare[marked[2]]
        if "\n" in word and not self._double.search(space + word):
            first, *rest = word.split("\n")
            if first and all(rest):
                return known[first] + b"".join(self.bare["\n"] + self.bare[r] for r in rest)
        return self._library(space + word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        gc.disable()  # nothing here is cyclic, and there are millions of pieces to walk over
        try:
            return [self._text(text) for text in texts]
        finally:
            gc.enable()

    def _text(self, text: str) -> bytes:
        if self._double.search(text):
            head, *rest = self._cut.split(text)
            rest = [r[1:] for r in rest]
        else:
            head, *rest = text.split(" ")
        return self.bare[head] + b"".join(map(self.spaced.__getitem__, rest))


def _encoder(tokenizer_file: str) -> Encoder:
    """The encoder of this Python worker.

    It is kept on the library's module, as functions reach a task by value: the
    tasks that follow in the same worker then know the pieces of earlier ones.
    """
    import tokenizers

    made = vars(tokenizers).setdefault("_tidemark_encoders", {})
    if tokenizer_file not in made:
        made[tokenizer_file] = Encoder(tokenizer_file)
    return made[tokenizer_file]


def write_ids(docs: DataFrame, tokenizer_file: str, path: str, parts: int | None = None) -> None:
    """Encode ``docs`` (``doc_id``, ``text``), each ended by ``END``, and write the segments to ``path``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file)
        part, id_type = TaskContext.get().partitionId(), None
        segment, begun = 0, 0
        ids: list[bytes] = []
        names: list = []
        held = 0

        def close() -> pa.RecordBatch:
            lengths = [len(i) // 4 for i in ids]
            payload = pack(np.frombuffer(b"".join(ids), "<u4"))
            columns = [[part], [segment], [begun], [sum(lengths)], [list(names)], [lengths], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["part", "segment", "part_start", "n_ids", "doc_ids", "lengths", "payload"],
            )

        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for key, found in zip(keys, encoder.encode(texts), strict=True):
                ids.append(found + end)
                names.append(key)
                held += len(ids[-1]) // 4
                if held >= SEGMENT:
                    yield close()
                    segment, begun, held = segment + 1, begun + held, 0
                    ids.clear()
                    names.clear()
        if ids:
            yield close()

    ordered.mapInArrow(run, _SCHEMA.format(kind=kind)).write.parquet(path)


def read_ids(
    spark: SparkSession,
    path: str,
    each: Callable[[memoryview], object] | None = None,
    returns: str = "ids binary",
) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens`` and its ids.

    ``ids`` are little-endian 32-bit numbers.  With ``each``, a column
    ``returns`` has the value of that function of them instead, computed
    where they are read.
    """
    stored = spark.read.parquet(path)
    files = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    offsets = cut(files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    name = returns.split()[0]
    own = each or bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            start, keys, lengths, payload = (c[0] for c in batch.columns)
            ids = memoryview(unpack(payload.as_py()).astype("<u4")).cast("B")
            ends = np.cumsum(lengths.as_py())
            starts = ends - lengths.as_py()
            found = [own(ids[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [keys.values, pa.array(starts + start.as_py(), pa.int64()), lengths.values, pa.array(found)],
                ["doc_id", "start", "n_tokens", name],
            )

    placed = stored.join(small(offsets, _FILES_TO_BROADCAST), "part").select(
        (F.col("base") + F.col("part_start")).alias("start"), "doc_ids", "lengths", "payload"
    )
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, {returns}")
