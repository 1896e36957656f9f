"""Following a growing table with a high-water mark.

A poll returns the rows past the mark; the mark is the largest (cursor, key)
pair handed out so far.  The key breaks ties, so rows that share a cursor
value are neither lost nor repeated when a poll ends in their midst; a NULL key
comes before all others.  Rows whose cursor is NULL or NaN have no place in that
order: they have a mark of their own, the largest key among them, and come
first.  Rows that arrive later with a position below the mark are seen only with an
overlap, which looks back by a bounded stretch.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, replace
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import named
from tidemark.session import run_dir

POLL_SECONDS = 10  # fixed value: pause between polls
POLL_ROWS = 3  # fixed value: rows per poll of the original watcher
LARGEST_LIMIT = 100_000  # the rows of a limited poll meet in one task

_STATE = (
    T.StructType()
    .add("poll", T.LongType())
    .add("cursor", T.StringType())
    .add("key", T.StringType())
    .add("key_is_null", T.BooleanType())
    .add("loose", T.BooleanType())
    .add("loose_key", T.StringType())
)


@dataclass(frozen=True)
class Mark:
    """A position in a table; values are text and take the column's type in a plan.

    ``key_is_null`` says that the row at the mark has a NULL key, which is not
    the same as a mark without a key.  ``loose`` says that rows without a cursor
    were seen, up to ``loose_key`` among them.
    """

    cursor: str | None
    key: str | None = None
    key_is_null: bool = False
    loose: bool = False
    loose_key: str | None = None


def _typed(df: DataFrame, column: str, text: str) -> Column:
    return F.lit(text).cast(df.schema[column].dataType)


def _mark_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        # With its offset, so that the text means the same instant in any session zone.
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    return value.cast("string")


def has_cursor(df: DataFrame, cursor: str) -> Column:
    """Whether a row has a place in the order of ``cursor``: it is neither NULL nor NaN."""
    known = named(cursor).isNotNull()
    if isinstance(df.schema[cursor].dataType, (T.FloatType, T.DoubleType)):
        return known & ~F.isnan(named(cursor))
    return known


def past_mark(df: DataFrame, mark: Mark, cursor: str, key: str | None = None) -> Column:
    """The rows with a cursor strictly after ``mark``; the bound reaches the scan."""
    placed = has_cursor(df, cursor)
    if mark.cursor is None:
        return placed
    bound = _typed(df, cursor, mark.cursor)
    if key is None or (mark.key is None and not mark.key_is_null):
        return placed & (named(cursor) > bound)
    later = named(key).isNotNull() if mark.key_is_null else named(key) > _typed(df, key, mark.key)
    return placed & (named(cursor) >= bound) & ((named(cursor) > bound) | later)


def unseen(df: DataFrame, mark: Mark | None, cursor: str, key: str) -> Column:
    """The rows a watch with ``mark`` has not handed out, rows without a cursor among them."""
    loose = ~has_cursor(df, cursor)
    if mark is None:
        return F.lit(True)
    if mark.loose and mark.loose_key is not None:
        loose = loose & (named(key) > _typed(df, key, mark.loose_key))
    elif mark.loose:
        loose = loose & named(key).isNotNull()
    return loose | past_mark(df, mark, cursor, key)


def poll(
    df: DataFrame,
    cursor: str,
    key: str | None = None,
    mark: Mark | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The rows after ``mark`` (all rows without one), at most ``limit`` of them.

    A limit takes the smallest positions first.  It is meant for small
    samples; leave it out to follow a large table.
    """
    rows = df if mark is None else df.where(past_mark(df, mark, cursor, key))
    if limit is None:
        return rows
    _check_limit(limit)
    order = [named(cursor).asc_nulls_last()]
    if key is not None:
        order.append(named(key).asc())
    return rows.orderBy(*order).limit(limit)


def poll_late(
    df: DataFrame, seen: DataFrame, cursor: str, key: str, mark: Mark, overlap: str | float
) -> DataFrame:
    """The rows after ``mark``, and those below it by at most ``overlap`` that were not ``seen``.

    ``overlap`` is an interval such as ``"2 days"`` for a cursor of times, else a number.
    Both tables are read from the start of the overlap on, so the exact comparison with what was
    handed out is bounded by the overlap and not by the age of the table.  A position is seen
    once: rows that agree with a seen one in cursor and key do not come again.
    """
    bound = _typed(df, cursor, mark.cursor)
    width = F.expr(f"INTERVAL {overlap}") if isinstance(overlap, str) else F.lit(overlap)
    # Computed once, so that it is a constant that reaches the scan.
    start = df.sparkSession.range(1).select(_mark_text((bound - width).cast(df.schema[cursor].dataType), df.schema[cursor].dataType)).first()[0]
    after = past_mark(df, mark, cursor, key)
    low = has_cursor(df, cursor) & (named(cursor) >= _typed(df, cursor, start))
    old = seen.where(named(cursor) >= _typed(df, cursor, start)).select(
        named(cursor).alias("__cursor"), named(key).alias("__key")
    )
    same = (named(cursor) == F.col("__cursor")) & named(key).eqNullSafe(F.col("__key"))
    late = df.where(low & ~after).join(old, same, "left_anti")
    return df.where(after).unionByName(late)


def _check_limit(limit: int) -> None:
    if limit > LARGEST_LIMIT:
        raise ValueError(f"a limit is for samples of up to {LARGEST_LIMIT} rows; leave it out")


def _first_positions(rows: DataFrame, cursor: str, key: str, limit: int) -> DataFrame:
    """The first ``limit`` rows and those that share the position of the last of them.

    Rows that agree in cursor and key cannot be told apart by a mark, so they
    are handed out together.
    """
    _check_limit(limit)
    placed = has_cursor(rows, cursor)
    order = F.struct(placed, F.when(placed, named(cursor)), named(key)).alias("__at")
    last = rows.select(order).orderBy("__at").limit(limit).agg(F.max("__at").alias("__last"))
    # One row, so the join is a broadcast of one value.
    return rows.withColumn("__at", order).join(F.broadcast(last), F.col("__at") <= F.col("__last")).drop("__at", "__last")


def _cut_into_polls(rows: DataFrame, cursor: str, key: str, limit: int) -> tuple[DataFrame, int]:
    """``rows`` with their ``poll`` from 0, and the number of polls: ``limit`` rows each in the order of positions.

    Rows that agree in cursor and key stay together, in the poll where the first of them falls;
    so a poll has less than ``limit`` rows more than the largest such group.  The order is made
    of ranges, whose rows are numbered on their own and moved on by those of the ranges before.
    """
    _check_limit(limit)
    spark = rows.sparkSession
    placed = has_cursor(rows, cursor)
    at = F.struct(placed, F.when(placed, named(cursor)), named(key)).alias("__at")
    ranges = rows.select(F.struct(*[named(c) for c in rows.columns]).alias("__row"), at).repartitionByRange("__at")
    kept = ranges.select("__row", "__at", F.spark_partition_id().alias("__range"))
    # Written, so that every later read finds the same ranges.
    folder = run_dir(spark, "polls")
    kept.write.parquet(folder)
    kept = spark.read.schema(kept.schema).parquet(folder)
    sizes = sorted(kept.groupBy("__range").count().collect())
    befores = list(accumulate([n for _, n in sizes], initial=0))
    before = spark.createDataFrame([(r, b) for (r, _), b in zip(sizes, befores)], "__range int, __before long")
    # The least number of the rows at a position.
    number = F.col("__before") + F.rank().over(Window.partitionBy("__range").orderBy("__at")) - 1
    cut = kept.join(F.broadcast(before), "__range").select("__row", F.floor(number / limit).alias("__cut"))
    # One row for each poll; a group of more than ``limit`` rows leaves cuts without any.
    used = sorted(r["__cut"] for r in cut.select("__cut").distinct().collect())
    polls = spark.createDataFrame(list(zip(used, range(len(used)), strict=True)), "__cut long, poll long")
    return cut.join(F.broadcast(polls), "__cut").select("__row.*", "poll"), len(used)


def high_water_mark(df: DataFrame, cursor: str, key: str | None = None) -> DataFrame:
    """One row: the largest ``cursor``, and with ``key`` the largest key at it; NaN is no cursor."""
    seen = df.where(has_cursor(df, cursor))
    if key is None or key == cursor:
        return seen.agg(F.max(named(cursor)).alias(cursor))
    top = seen.agg(F.max(F.struct(named(cursor), named(key))).alias("top"))
    return top.select(*[named("top").getField(c).alias(c) for c in (cursor, key)])


@dataclass(frozen=True)
class TableWatch:
    """Polls of one table, each written once, with the mark kept on shared storage.

    ``scan`` is called for every poll and returns the table as it is then.
    Poll *n* goes to ``out/poll=n`` and the mark is taken from what was
    written there.  With ``overlap`` a poll also takes rows that arrived below the
    mark by at most that much, see ``poll_late``.  The mark is stored last, in one of two slots used in
    turn: a crash leaves the previous slot intact, and the next run repeats
    poll *n* into the same place.
    """

    spark: SparkSession
    scan: Callable[[], DataFrame]
    cursor: str
    key: str
    out: str
    state: str
    limit: int | None = None
    overlap: str | float | None = None

    def last(self) -> tuple[int, Mark | None]:
        """The number of the last finished poll (-1 before the first) and its mark."""
        try:
            slots = self.spark.read.schema(_STATE).parquet(self.state)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return -1, None
            raise
        row = slots.orderBy(F.col("poll").desc()).first()
        if row is None:
            return -1, None
        mark = Mark(row["cursor"], row["key"], *[bool(row[c]) for c in ("key_is_null", "loose")], row["loose_key"])
        return row["poll"], mark

    def advance(self, all_polls: bool = False) -> int:
        """One poll.  Returns the number of new rows; an empty poll keeps the mark.

        With ``all_polls`` and a limit, as many polls as the rows of one scan need, each
        in its place: a poll on its own reads the table for every ``limit`` rows.  The mark
        is stored after the last of them, so a crash repeats them all.
        """
        done, mark = self.last()
        number = done + 1
        table = self.scan()
        new = table.where(unseen(table, mark, self.cursor, self.key))
        if self.overlap is not None and mark is not None and mark.cursor is not None:
            placed = table.where(has_cursor(table, self.cursor))
            loose = new.where(~has_cursor(table, self.cursor))
            new = loose.unionByName(poll_late(placed, self.seen(), self.cursor, self.key, mark, self.overlap))
        columns = T.StructType([*new.schema.fields, T.StructField("poll", T.LongType())])
        polls = 0
        if self.limit is not None and all_polls:
            several, polls = _cut_into_polls(new, self.cursor, self.key, self.limit)
        if polls:
            several = several.withColumn("poll", F.col("poll") + number)
            several.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("poll").parquet(self.out)
            number = done + polls
            these = F.col("poll").between(done + 1, number)
            written = self.spark.read.schema(columns).parquet(self.out).where(these).drop("poll")
        else:
            if self.limit is not None:
                new = _first_positions(new, self.cursor, self.key, self.limit)
            target = f"{self.out}/poll={number}"
            new.write.mode("overwrite").parquet(target)
            written = self.spark.read.schema(new.schema).parquet(target)
        placed = has_cursor(written, self.cursor)
        position = F.struct(named(self.cursor).alias("cursor"), named(self.key).alias("key"))
        summary = written.agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(placed, position)).alias("top"),
            F.count(F.when(~placed, 1)).alias("n_loose"),
            F.max(F.lit(True) if mark is None else past_mark(written, mark, self.cursor, self.key)).alias("past"),
            F.max(F.when(~placed, named(self.key))).alias("loose_key"),
        )
        kinds = {part: new.schema[c].dataType for part, c in (("cursor", self.cursor), ("key", self.key))}
        state = summary.select(
            "n",
            "n_loose",
            F.coalesce("past", F.lit(False)).alias("past"),
            *[_mark_text(F.col("top").getField(p), kinds[p]).alias(p) for p in ("cursor", "key")],
            _mark_text(F.col("loose_key"), kinds["key"]).alias("loose_key"),
        ).first()
        if state["n"]:
            moved = self._moved(mark or Mark(None), state)
            row = {"poll": number, **asdict(moved)}
            slot = self.spark.range(0, 1, 1, 1).select(
                *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in _STATE.fields]
            )
            slot.write.mode("overwrite").parquet(f"{self.state}/slot={number % 2}")
        return state["n"]

    @staticmethod
    def _moved(mark: Mark, state: Row) -> Mark:
        """``mark`` after the rows that ``state`` sums up; late rows leave it as it is."""
        if state["cursor"] is not None and state["past"]:
            mark = replace(mark, cursor=state["cursor"], key=state["key"], key_is_null=state["key"] is None)
        if state["n_loose"]:
            mark = replace(mark, loose=True, loose_key=state["loose_key"] or mark.loose_key)
        return mark

    def run(self, every: float = POLL_SECONDS, polls: int | None = None) -> Iterator[int]:
        """Poll again and again, yielding the number of new rows each time."""
        done = 0
        while polls is None or done < polls:
            yield self.advance()
            done += 1
            if polls is None or done < polls:
                time.sleep(every)

    def seen(self) -> DataFrame:
        """All rows of finished polls, with their ``poll`` number."""
        done, _ = self.last()
        schema = T.StructType([*self.scan().schema.fields, T.StructField("poll", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.out).where(F.col("poll") <= done)
