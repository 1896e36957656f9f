"""Following a table: every row exactly once, also with ties and after crashes."""

import datetime as dt
import itertools
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import Mark, TableWatch, high_water_mark, poll
from tidemark.plans import watch_table

_numbers = itertools.count()


def _watch(spark, folder, scan, **more):
    base = f"{folder}/{next(_numbers)}"
    return TableWatch(spark, scan, "c", "id", f"{base}/out", f"{base}/mark", **more)


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_first_poll_takes_everything_later_ones_what_is_past_the_mark(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, None)], "id int, c int")
    assert _ids(poll(df, "c")) == [1, 2, 3, 4]
    assert _ids(poll(df, "c", mark=Mark("10"))) == [2, 3]
    assert _ids(poll(df, "c", mark=Mark("20"))) == []
    assert _ids(poll(df, "c", "id", Mark("20", "2"))) == [3]
    assert [r["id"] for r in poll(df, "c", "id", limit=2).collect()] == [1, 2]
    with pytest.raises(ValueError, match="leave it out"):
        poll(df, "c", "id", limit=10**9)


def test_mark_is_the_largest_pair(spark):
    df = spark.createDataFrame([(9, 10), (2, 20), (1, 20), (4, None)], "id int, c int")
    assert tuple(high_water_mark(df, "c", "id").first()) == (20, 2)
    assert tuple(high_water_mark(df, "c").first()) == (20,)
    assert tuple(high_water_mark(df.where("c > 99"), "c", "id").first()) == (None, None)


def test_orders_are_seen_exactly_once_in_small_polls(spark, sf_dir, folder):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("c")
    )
    total = orders.count()
    watch = _watch(spark, folder, lambda: orders, limit=max(1, total // 7))
    sizes = list(itertools.takewhile(bool, watch.run(every=0)))
    assert sum(sizes) == total and len(sizes) >= 7
    seen = watch.seen()
    assert seen.count() == total and seen.select("id").distinct().count() == total
    assert orders.groupBy("c").count().where("count > 1").count() > 0  # there are ties


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 4), min_size=1, max_size=12),
    st.integers(1, 5),
)
def test_ties_are_neither_lost_nor_repeated(spark, folder, cursors, limit):
    df = spark.createDataFrame(list(enumerate(cursors)), "id int, c int")
    watch = _watch(spark, folder, lambda: df, limit=limit)
    list(itertools.takewhile(bool, watch.run(every=0)))
    assert _ids(watch.seen()) == list(range(len(cursors)))


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("timestamp", ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002", "2024-07-01 12:00:00"]),
        ("timestamp_ntz", ["2024-03-10 02:30:00", "2024-03-10 02:30:00.5", "2024-03-11 00:00:00"]),
        ("date", ["2024-01-01", "2024-01-02", "2024-01-03"]),
        ("double", ["0.1", "0.30000000000000004", "1e300"]),
        ("decimal(38,10)", ["1.0000000001", "12345678901234567890.0000000001", "99999999999999999999"]),
        ("string", ["a'b", "b\"c", "é"]),
    ],
)
def test_marks_of_any_type_survive_storage(spark, folder, kind, values):
    rows = spark.createDataFrame(list(enumerate(values)), "id int, t string").select(
        "id", F.col("t").cast(kind).alias("c")
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        watch = _watch(spark, folder, lambda: rows, limit=1)
        assert watch.advance() == 1
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert [n for n in watch.run(every=0, polls=3)] == [1, 1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert _ids(watch.seen()) == [0, 1, 2]


def test_a_crash_before_the_mark_repeats_the_poll_in_place(spark, folder):
    rows = [(1, 1), (2, 2)]
    table = lambda: spark.createDataFrame(rows, "id int, c int")
    watch = _watch(spark, folder, table)
    assert watch.advance() == 2
    # Poll 1 is written, its mark is not.
    rows.append((3, 3))
    poll(table(), "c", "id", Mark("2", "2")).write.parquet(f"{watch.out}/poll=1")
    assert _ids(watch.seen()) == [1, 2]
    rows.append((4, 3))
    assert watch.advance() == 2
    assert _ids(watch.seen()) == [1, 2, 3, 4]
    assert watch.last() == (1, Mark("3", "4"))


def test_a_lost_slot_falls_back_to_the_mark_before(spark, folder):
    rows = [(1, 1)]
    table = lambda: spark.createDataFrame(rows, "id int, c int")
    watch = _watch(spark, folder, table)
    watch.advance()
    rows.append((2, 2))
    watch.advance()
    # As if the write of the second slot had been cut short.
    empty = spark.createDataFrame([], "poll bigint, cursor string, key string")
    empty.write.mode("overwrite").parquet(f"{watch.state}/slot=1")
    assert watch.last() == (0, Mark("1", "1"))
    assert watch.advance() == 1
    assert _ids(watch.seen()) == [1, 2]


def test_empty_polls_keep_the_mark(spark, folder):
    rows = []
    table = lambda: spark.createDataFrame(rows, "id int, c int")
    watch = watch_table(spark, table, "c", "id", f"{folder}/out", f"{folder}/mark")
    assert watch.last() == (-1, None) and watch.advance() == 0 and watch.last() == (-1, None)
    rows.append((1, 5))
    assert watch.advance() == 1 and watch.advance() == 0
    assert watch.last() == (0, Mark("5", "1"))


def test_the_key_can_be_the_cursor(spark, folder):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    watch = watch_table(
        spark, lambda: df, "id", "id", f"{folder}/out", f"{folder}/mark", limit=2
    )
    assert list(watch.run(every=0, polls=3)) == [2, 1, 0]
    assert high_water_mark(df, "id", "id").collect() == [(3,)]


def test_rows_without_cursor_are_taken_once(spark, folder):
    df = spark.createDataFrame([(1, None), (2, 7)], "id int, c int")
    watch = _watch(spark, folder, lambda: df)
    assert list(watch.run(every=0, polls=2)) == [2, 0]


def test_the_mark_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    mark = Mark("1996-01-01 00:00:00", "5")
    plan = poll(orders, "o_orderdate", "o_orderkey", mark)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "Exchange" not in text
    newest = orders.agg(F.max("o_orderdate")).first()[0]
    assert isinstance(newest, dt.datetime)


@pytest.mark.parametrize("limit", [None, 1, 3])
@pytest.mark.parametrize("dtype", ["int", "double"])
def test_rows_without_a_cursor_come_once(spark, folder, limit, dtype):
    nan = float("nan") if dtype == "double" else None
    rows = [(1, 5), (2, None), (3, nan), (4, 5), (None, 5), (None, None), (None, None), (5, None), (6, 9), (None, 9)]
    schema = f"id int, c {dtype}"
    grown = [rows, [*rows, (7, None), (8, 9), (9, nan), (10, 11)]]
    now = [grown[0]]

    def scan():
        cast = [(i, None if c is None else (float(c) if dtype == "double" else c)) for i, c in now[-1]]
        return spark.createDataFrame(cast, schema)

    watch = _watch(spark, folder, scan, limit=limit)
    for state in grown:
        now.append(state)
        while watch.advance():
            pass
    seen = sorted(str(r["id"]) for r in watch.seen().collect())
    assert seen == sorted(str(i) for i, _ in grown[-1])


def test_nan_is_no_mark(spark):
    df = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, None)], "id int, c double")
    assert high_water_mark(df, "c").first()[0] == 2.0
    assert _ids(poll(df, "c", mark=Mark("1.0"))) == [1]


def test_a_late_arrival_is_seen_at_a_short_interval(spark, folder):
    rows = [[(1, 1)], [(1, 1), (2, 2)], [(1, 1), (2, 2)]]
    states = iter(rows)
    watch = _watch(spark, folder, lambda: spark.createDataFrame(next(states), "id int, c int"))
    began = time.monotonic()
    assert list(watch.run(every=0.3, polls=3)) == [1, 1, 0]
    assert time.monotonic() - began >= 0.6


@pytest.mark.parametrize("ties", [False, True])
def test_all_polls_of_a_limit_read_the_table_once(spark, folder, ties):
    """As many polls as one after the other would be, each within its limit, from a bounded number of scans."""
    read = spark.sparkContext.accumulator(0)
    rows = [(i % 5 if i % 7 else None, None if i % 11 == 0 else i // (4 if ties else 1)) for i in range(600)]
    rows += [(2, 9)] * 45 * ties  # one position with more rows than a poll
    rows += [] if ties else [(None, None)]

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    now = [rows]

    def scan():
        return spark.createDataFrame(now[-1], "c int, id int").mapInArrow(counted, "c int, id int")

    watch = _watch(spark, folder, scan, limit=20)
    assert watch.advance(all_polls=True) == len(rows)
    assert read.value <= 3 * len(rows)  # 31 polls before
    sizes = {r["poll"]: r["count"] for r in watch.seen().groupBy("poll").count().collect()}
    assert sorted(sizes) == list(range(len(sizes))) and watch.last()[0] == len(sizes) - 1
    key = lambda r: (r["c"] is not None, r["c"] or 0, r["id"] is not None, r["id"] or 0)
    seen = watch.seen().collect()
    assert sorted(map(key, seen)) == sorted((c is not None, c or 0, i is not None, i or 0) for c, i in rows)
    # Polls follow each other in the order of positions and share none.
    spans = {}
    for r in seen:
        low, high = spans.get(r["poll"], (key(r), key(r)))
        spans[r["poll"]] = (min(low, key(r)), max(high, key(r)))
    assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))
    most = max(map(len, (list(g) for _, g in itertools.groupby(sorted(map(key, seen))))))
    assert max(sizes.values()) < 20 + most
    # What comes later follows, with polls of either kind; polls that never got a mark are written again.
    spark.createDataFrame([(99, 99)], "c int, id int").write.parquet(f"{watch.out}/poll={len(sizes)}")
    now.append([*rows, (7, 1), (None, 1000), (8, 2)])
    assert watch.advance(all_polls=True) == 3
    now.append([*now[-1], (9, 1)])
    assert [watch.advance(), watch.advance(all_polls=True)] == [1, 0]
    assert watch.seen().count() == len(rows) + 4


def test_all_polls_of_an_empty_table(spark, folder):
    watch = _watch(spark, folder, lambda: spark.createDataFrame([], "c int, id int"), limit=5)
    assert watch.advance(all_polls=True) == 0
    assert watch.seen().count() == 0
