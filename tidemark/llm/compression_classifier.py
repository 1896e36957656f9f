"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are built from labelled good and bad texts.  A text is
compressed whole with each; the difference of the two sizes over the number of
its bytes is the only feature: text like the good examples is shorter with the
good dictionary.  A logistic curve, fitted on labelled texts that the
dictionaries have not seen and weighted to the true share of the classes, turns
it into a probability.

Only rows whose ``crc32(doc_id as text) mod 5`` is not 0 are learned from.  The
model is fitted on a bounded sample: at most ``SAMPLE`` labelled texts of each
class (the first by the MD5 of their id) of at most ``LONGEST`` bytes; every
text is scored whole.

Defined results: null and empty texts have no difference (0) and get the curve's
value there; without labels of both classes the score of every text is the
share of good labels (0.5 without any); a null id is not held out; several
labels of one id count as the lowest; repeated rows score alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

FOLDS = 5
SAMPLE = 3000
LONGEST = 100_000
DICTIONARY = 256 * 1024
LEVEL = 3
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _dictionary(samples: list[bytes]) -> tuple[bytes, int]:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY, samples)
        return trained.as_bytes(), zstandard.DICT_TYPE_FULLDICT
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY:], zstandard.DICT_TYPE_RAWCONTENT


def _compressor(content: bytes, kind: int) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=kind)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False
    )


@dataclass(frozen=True)
class Model:
    good: tuple[bytes, int] | None
    bad: tuple[bytes, int] | None
    slope: float
    intercept: float

    def compressors(self) -> tuple | None:
        """The compressors with the good and the bad dictionary, to be made once per task."""
        return (_compressor(*self.good), _compressor(*self.bad)) if self.good and self.bad else None

    def differences(self, texts: list[bytes], pair: tuple | None) -> np.ndarray:
        if not pair:
            return np.zeros(len(texts))
        good, bad = pair
        return np.array([(len(bad.compress(t)) - len(good.compress(t))) / max(len(t), 1) for t in texts])

    def scores(self, texts: list[bytes], pair: tuple | None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts, pair) + self.intercept, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a small penalty on the slope."""
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones(len(x))])
    beta, penalty = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ z, -30, 30)))
        step = np.linalg.solve(
            (z * (weight * p * (1 - p))) @ z.T + penalty, z @ (weight * (y - p)) - penalty @ beta
        )
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0] / scale), 0.0), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model learned from the labelled rows that are not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality in (0, 1)")
    )
    count = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    all_rows = sum(count.values())
    if len(count) < 2:
        share = count.get(1, 0) / all_rows if all_rows else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(None, None, 0.0, math.log(share / (1 - share)))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    # At most 2 x sample rows, so they may be broadcast and their texts collected.
    chosen = [known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(sample) for q in (0, 1)]
    rows = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .filter(F.octet_length("text") <= LONGEST)
        .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
        .dropDuplicates(["doc_id"])
        .orderBy(order, "doc_id")
        .collect()
    )
    texts = {q: [bytes(r["text"]) for r in rows if r["quality"] == q and r["text"]] for q in (0, 1)}
    if not all(len(t) > 1 for t in texts.values()):
        return Model(None, None, 0.0, math.log(count[1] / count[0]))
    # Every other text builds a dictionary, the rest fits the curve.
    made = {q: _dictionary(t[0::2]) for q, t in texts.items()}
    rest = {q: t[1::2] for q, t in texts.items()}
    model = Model(made[1], made[0], 1.0, 0.0)
    x = model.differences(rest[0] + rest[1], model.compressors())
    y = np.r_[np.zeros(len(rest[0])), np.ones(len(rest[1]))]
    weight = np.r_[np.full(len(rest[0]), count[0] / len(rest[0])), np.full(len(rest[1]), count[1] / len(rest[1]))]
    slope, intercept = _logistic(x, y, weight * len(y) / weight.sum())
    return Model(made[1], made[0], slope, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors()
        for batch in slices(batches):
            found = model.scores([t or b"" for t in batch.column(2).to_pylist()], pair)
            predicted = pa.array((found >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), predicted],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary")
    ).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
