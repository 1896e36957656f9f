"""Result pages: envelopes out of rows and rows out of envelopes."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rowtext import row_json_array, row_json_object
from tidemark.sources import flatten_pages, page_schema, page_schemas, pages_with, result_pages

SIMPLE = """
SELECT id, IF(id % 5 = 0, null, concat('é"\\\\', id, '\n')) AS s, id / 7 AS f, id % 2 = 0 AS b,
       timestampadd(MICROSECOND, id, timestamp_ntz'2024-01-01') AS t,
       date_add(date'2024-01-01', CAST(id AS int)) AS d, CAST(CAST(id AS string) AS binary) AS raw
FROM range(997)
"""
NESTED = """
SELECT id, CAST(id AS decimal(30, 10)) + 12345678901234567890.0123456789BD AS d,
       array(id, null) AS l, CAST(id AS string) AS s
FROM range(50)
"""


@pytest.mark.parametrize("query", [SIMPLE, NESTED])
@pytest.mark.parametrize("size", [1, 10, 100000])
def test_pages_flatten_back_to_the_table(spark, query, size):
    df = spark.sql(query)
    pages = result_pages(df.repartition(3), size)
    got = flatten_pages(pages, df.schema)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def test_pages_are_bounded_and_well_formed(spark):
    df = spark.range(1000).repartition(3)
    pages = result_pages(df, 64).collect()
    assert max(p["n_rows"] for p in pages) <= 64
    assert sum(p["n_rows"] for p in pages) == 1000
    for page in pages:
        body = json.loads(page["body"])
        assert body["columns"] == [{"name": "id", "type": "bigint"}]
        assert len(body["data"]) == page["n_rows"]


def test_pages_of_long_rows_are_bounded_by_size(spark):
    df = spark.range(200).repartition(2).selectExpr(
        "id", "repeat('x', IF(id % 50 = 0, 5000, CAST(id AS int))) AS text"
    )
    pages = result_pages(df, 1000, 1000).collect()
    assert sum(p["n_rows"] for p in pages) == 200
    assert all(len(p["body"]) < 1600 for p in pages if p["n_rows"] > 1)
    assert sum(p["n_rows"] == 1 and len(p["body"]) > 5000 for p in pages) == 4
    again = flatten_pages(spark.createDataFrame(pages), df.schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


def test_pages_need_no_shuffle(spark, sf_dir):
    pages = result_pages(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    df = spark.range(0)
    assert result_pages(df).collect() == []


def test_page_size_is_checked(spark):
    with pytest.raises(ValueError):
        result_pages(spark.range(1), 0)


def test_pages_without_rows_and_broken_bodies(spark):
    bodies = [
        (1, '{"nextUri":"more","stats":{}}'),
        (2, '{"columns":[{"name":"a","type":"bigint"},{"name":"b","type":"varchar(5)"}],"data":[[1,"x"],[2,null]]}'),
        (3, '{"data":[]}'), (4, "junk"), (5, "[[1,2]]"), (6, None), (7, '{"data":[[3,"y"]]} tail'),
        (8, '{"data":[[4,"z"]]}'),
    ]
    pages = spark.createDataFrame(bodies, "page int, body string")
    schema = page_schema(pages)
    assert schema.simpleString() == "struct<a:bigint,b:string>"
    got = flatten_pages(pages, schema, keep=["page"]).collect()
    assert {tuple(r) for r in got} == {(2, 1, "x"), (2, 2, None), (8, 4, "z")}
    exact = flatten_pages(pages, T.StructType().add("a", "decimal(5,1)").add("b", "string"))
    assert sorted(float(r["a"]) for r in exact.collect()) == [1.0, 2.0, 4.0]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("varchar", "string"), ("varchar(25)", "string"), ("integer", "int"), ("real", "float"),
        ("double", "double"), ("bigint", "bigint"), ("boolean", "boolean"), ("date", "date"),
        ("timestamp(6)", "timestamp_ntz"), ("timestamp(3) with time zone", "timestamp"),
        ("decimal(12,2)", "decimal(12,2)"), ("varbinary", "binary"), ("timestamp_ntz", "timestamp_ntz"),
    ],
)
def test_type_names_of_envelopes(spark, name, expected):
    body = json.dumps({"columns": [{"name": "c", "type": name}], "data": []})
    schema = page_schema(spark.createDataFrame([(body,)], "body string"))
    assert schema["c"].dataType.simpleString() == expected


def test_schema_needs_a_page_with_columns(spark):
    with pytest.raises(ValueError, match="columns"):
        page_schema(spark.createDataFrame([("{}",), ("x",)], "body string"))


def test_rows_that_do_not_fit_are_kept(spark):
    data = [["x", "a"], [1, "b"], [2], [3, "c", "more"], [None, None]]
    pages = spark.createDataFrame([(json.dumps({"data": data}),)], "body string")
    for dtype in ("long", "decimal(20,0)"):
        schema = T.StructType().add("n", dtype).add("s", "string")
        rows = flatten_pages(pages, schema, unfit="bad").collect()
        assert [(None if r["n"] is None else int(r["n"]), r["s"]) for r in rows] == [
            (None, "a"), (1, "b"), (2, None), (3, "c"), (None, None),
        ]
        assert [r["bad"] is not None for r in rows] == [True, False, True, True, False]
        assert "more" in rows[3]["bad"]


@pytest.mark.parametrize(
    "name,expected",
    [
        ("timestamp with time zone", "timestamp"),
        ("timestamp(3) with time zone", "timestamp"),
        ("array(bigint)", "array<bigint>"),
        ("map(varchar(10), array(integer))", "map<string,array<int>>"),
        ("row(a integer, \"B c\" row(x varchar, double))", "struct<a:int,B c:struct<x:string,field1:double>>"),
        ("time(6)", "string"),
    ],
)
def test_nested_type_names_of_envelopes(spark, name, expected):
    body = json.dumps({"columns": [{"name": "c", "type": name}], "data": []})
    schema = page_schema(spark.createDataFrame([(body,)], "body string"))
    assert schema["c"].dataType.simpleString() == expected


def test_two_result_sets_flatten_to_their_own_tables(spark):
    one = spark.createDataFrame([(1, "x")], "a long, b string")
    two = spark.createDataFrame([("7", 2.5)], "b string, c double")
    pages = result_pages(one).unionByName(result_pages(two))
    found = {}
    for header, schema in page_schemas(pages).items():
        rows = flatten_pages(pages_with(pages, header), schema)
        found[tuple(rows.columns)] = [tuple(r) for r in rows.collect()]
    assert found == {("a", "b"): [(1, "x")], ("b", "c"): [("7", 2.5)]}


def test_instants_survive_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = spark.createDataFrame([(1730611800,), (1730615400,)], "s long").select(
            F.timestamp_seconds("s").alias("t")
        )
        texts = [r[0] for r in times.select(row_json_array(times)).collect()]
        assert texts == ['["2024-11-03T01:30:00-04:00"]', '["2024-11-03T01:30:00-05:00"]']
        objects = [r[0] for r in times.select(row_json_object(times)).collect()]
        assert len(set(objects)) == 2
        back = flatten_pages(result_pages(times), times.schema).select(F.unix_seconds("t"))
        assert sorted(r[0] for r in back.collect()) == [1730611800, 1730615400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_times_of_day_have_a_text(spark):
    row = spark.sql("SELECT TIME'10:20:30.5' AS t, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS n")
    assert row.select(row_json_object(row)).first()[0] == '{"t":"10:20:30.500000","n":"2024-01-02T03:04:05"}'
    assert row.select(row_json_array(row)).first()[0] == '["10:20:30.500000", "2024-01-02T03:04:05"]'
