"""Small helpers shared by the operators: words, window hashes, cut points."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the control characters 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Rows of a few numbers each that one task gets of a cut point, about.
ROWS_AT_ONCE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *needed: str | Column) -> DataFrame:
    """The rows of ``docs`` as one struct ``__packed``, beside the columns ``needed``.

    Whatever the columns are called, they cannot clash with those that an operator adds;
    ``select("__packed.*")`` gives them back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__packed"), *needed)


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session without it (tests on one machine) gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut(frame: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the cluster."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


@contextmanager
def planned_once(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """What runs in here is not planned anew after each of its stages, and shuffled to ``partitions`` if given.

    Each stage of an adaptive plan costs the driver a thread, a job and one more plan.  That pays where a plan
    may have to change for large or skewed rows, not for rows that are counted and few.
    """
    settings = {"spark.sql.adaptive.enabled": "false"}
    if partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def settled(frame: DataFrame, most: int | None = None, per_task: int = ROWS_AT_ONCE) -> tuple[DataFrame, int]:
    """A cut point of ``frame`` in few tasks of about ``per_task`` rows, and a number that its rows do not exceed.

    ``most`` is such a number, if known, of the rows that it is made of as well.  So few that one task gets them are
    planned once, for one partition; others are counted.
    """
    spark = frame.sparkSession
    if most is not None and most < ROWS_AT_ONCE:
        with planned_once(spark, 1):
            return cut(frame).coalesce(most // per_task + 1), most
    found = cut(frame)
    with planned_once(spark):
        rows = found.count()
    return found.coalesce(rows // per_task + 1), rows


def release(spark: SparkSession) -> None:
    """Drop the checkpoints, shuffles and broadcasts that nothing refers to any more.

    Spark drops them when the driver happens to collect its garbage, which may be long after the last round
    that needs them; the driver then gives back heap it does not use, too.
    """
    gc.collect()  # frames of Python keep theirs in the JVM
    spark.sparkContext._jvm.System.gc()


def small(frame: DataFrame, most: int) -> DataFrame:
    """``frame`` marked for broadcasting if it has at most ``most`` rows, else unchanged.

    ``frame`` should be a cut point, as its rows are counted here.
    """
    fits = frame.limit(most + 1).count() <= most
    return F.broadcast(frame) if fits else frame


def _pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def with_window_hashes(frame: DataFrame, source: str, target: str, length: int) -> DataFrame:
    """Add the 64-bit hashes of all windows of ``length`` words, in order, as ``target``.

    Hashes of 1, 2, 4, ... words are combined, so the work per word grows with
    the logarithm of the length.  Fewer words than ``length`` give no window.
    Every array is a column of its own: an expression used twice inside lambdas
    would otherwise be evaluated for each element.
    """
    n = F.size(source)

    def part(name: str, skip: int, less: int) -> Column:
        return F.slice(name, F.lit(skip + 1), F.greatest(n - less, F.lit(0)))

    powers = [1]
    frame = frame.withColumn("__h1", F.transform(source, lambda w: F.xxhash64(w)))
    while powers[-1] * 2 <= length:
        p = powers[-1]
        less = 2 * p - 1
        frame = frame.withColumn(
            f"__h{2 * p}",
            F.zip_with(part(f"__h{p}", 0, less), part(f"__h{p}", p, less), _pair),
        )
        powers.append(2 * p)
    name, done = f"__h{powers[-1]}", powers[-1]
    for p in reversed(powers[:-1]):
        if done + p <= length:
            joined, less = f"__h{done}_{p}", done + p - 1
            frame = frame.withColumn(
                joined, F.zip_with(part(name, 0, less), part(f"__h{p}", done, less), _pair)
            )
            name, done = joined, done + p
    frame = frame.withColumn(target, F.col(name))
    return frame.drop(*[c for c in frame.columns if c.startswith("__h")])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller ones, so that few texts at a time become Python values."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the given values only: 52 bits of their MD5."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
