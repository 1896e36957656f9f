"""What counts as a document, and how fields come out of it."""

import json
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import (
    apply_schema,
    flatten_struct,
    infer_schema,
    only_documents,
    parse_documents,
    parse_struct,
)
from tidemark.operators.parsing import document_field
from tidemark.session import configure

OBJECTS = [
    '{"Name":"Alex"}', '{"Name":5}', '{"Other":1}', "{}", '{"Name":1.50}', '{"Name":{"a": 1}}',
    '{"Name":[1, "x"]}', '{"Name":true}', '{"Name":null}', '{"name":"lc"}', '{"k":"5"}',
    '{"k":5.0}', '{"k":"x","Name":"z"}', '{"k":"x"}', '{"k":12345678901234567890}', '{"k":1e3}',
    '{"d":{"x":1,"y":[1,2]}}', '{"d":{"x":"q","y":[1,"w"]},"k":1}', '{"d":[1]}',
    '{"d":5,"Name":"r"}', '  {"Name":"w"}\n', '\t{"Name":"tab"}', '{"Name":"1","Name":"2"}',
    '{"k":1,"x":NaN}', '{"x":[-Infinity,Infinity],"k":2}',
    '{"Name":"é\\n\\u00e9 \\"q\\""}', '{"__seal":5,"Name":"s"}', '{"Name":"]"}', '{"Name":"}{"}',
]
OTHERS = ['["a","b"]', '[{"Name":"x"},{"Name":"y"}]', '"s"', "5", "null", "true", "[]", "[{}]"]
BROKEN = [
    "not json", "", " ", None, '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}] x',
    '{"a":1}],[{"b":1}', "{'Name':1}", '{"Name":', '1,{"__seal":5}', '{"a":1}, 7] x',
    '{"a":1} // c', '{"Name":"x"}\x00', "\ufeff{}", '{"a":01}', "{a:1}", '{"x":INF}', '{"x":-INF,"k":1}', '{"Name":"NaN",}', 'NaN of {"a":1}', '{"a":1}}', '{"a":1}],"x":[{}',
]

SCHEMA = (
    T.StructType()
    .add("Name", T.StringType())
    .add("k", T.LongType())
    .add("d", T.StructType().add("x", T.IntegerType()).add("y", T.ArrayType(T.IntegerType())))
)


@pytest.fixture(scope="module")
def messages(spark):
    cases = [*OBJECTS, *OTHERS, *BROKEN]
    return spark.createDataFrame(list(enumerate(cases)), "i int, value string").cache()


def _python_status(text):
    try:
        return "stored" if isinstance(json.loads(text), dict) else "not_document"
    except (TypeError, ValueError):
        return "malformed"


def test_status_is_what_a_json_decoder_says(messages):
    got = {r["value"]: r["status"] for r in parse_documents(messages).collect()}
    assert got == {v: _python_status(v) for v in [*OBJECTS, *OTHERS, *BROKEN]}


def _json_like(random, depth=0):
    kind = random.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return random.choice(["null", "true", "false", "nul", "NaN", "Infinity", "-Infinity"])
    if kind == 1:
        return random.choice(
            ["0", "-0", "-1", "01", "1.", "-1.50", "1E+5", "1e", "1e400", ".5", "+1", "-", "1" * 60]
        )
    if kind in (2, 3):
        parts = ["", "a", "é", "\\n", "\\u00e9", "\\ud800", "\\x", "\\", "\t", "\x00", "😀", '\\"', "]", "}"]
        return '"' + "".join(random.choices(parts, k=2)) + '"'
    if kind in (4, 5):
        names = ['"k"', '"Name"', '"d"', '"x"', '"y"', '""', "a", "'q'"]
        weights = [8, 8, 8, 4, 4, 2, 1, 1]
        pairs = [
            random.choices(names, weights)[0] + random.choice([":", " : "]) + _json_like(random, depth + 1)
            for _ in range(random.randrange(4))
        ]
        return "{" + ",".join(pairs) + random.choice([""] * 6 + [","]) + "}"
    return "[" + ",".join(_json_like(random, depth + 1) for _ in range(random.randrange(4))) + "]"


def _damaged(random, text):
    for _ in range(random.choice([0, 0, 0, 1, 1, 2])):
        at, how = random.randrange(len(text) + 1), random.randrange(4)
        if how == 0:
            text = text[:at] + text[at + 1 :]
        elif how == 1:
            text = text[:at] + random.choice('{}[]",:\\ 0ae-.\n\x0b\xa0') + text[at:]
        elif how == 2:
            text += random.choice([" x", "}", "]", ",1", "{}", " ", "\n", "\x00", "//c", ',{"__seal":1}'])
        else:
            text = random.choice([" ", "\ufeff", "\n", "\x0c", "/*c*/", "[", "{"]) + text
    return text


def test_generated_messages(spark):
    random = Random(7)
    cases = sorted({_damaged(random, _json_like(random)) for _ in range(6000)})
    df = spark.createDataFrame(list(enumerate(cases)), "i int, value string").repartition(8)
    status = {r["i"]: r["status"] for r in parse_documents(df).collect()}
    wrong = [c for i, c in enumerate(cases) if status[i] != _python_status(c)]
    assert not wrong, wrong[:5]
    stored = {i for i, s in status.items() if s == "stored"}
    assert len(stored) > 150
    assert {r["i"] for r in only_documents(df).select("i").collect()} == stored
    typed = {r["i"]: str(tuple(r)[1:]) for r in apply_schema(df, SCHEMA, keep=["i"]).collect()}
    plain = {r["i"]: r["data"] for r in parse_struct(df, SCHEMA).collect()}
    assert typed == {i: str(tuple(plain[i])) for i in stored}


def test_only_objects_have_a_document(messages):
    parsed = parse_documents(messages).collect()
    alone = parse_documents(messages, doc=None)
    assert alone.columns == ["i", "value", "status"]
    assert sorted(tuple(r) for r in alone.select("i", "status").collect()) == sorted(
        (r["i"], r["status"]) for r in parsed
    )
    assert {r["value"] for r in parsed if r["doc"] is not None} == set(OBJECTS)
    assert {r["value"] for r in only_documents(messages).collect()} == set(OBJECTS)
    assert {r["i"] for r in apply_schema(messages, SCHEMA, keep=["i"]).collect()} == set(
        range(len(OBJECTS))
    )


def test_typed_columns_equal_the_plain_parse(messages):
    plain = {r["i"]: tuple(r["data"]) for r in parse_struct(messages, SCHEMA).collect()[: len(OBJECTS)]}
    typed = {r[0]: tuple(r)[1:] for r in apply_schema(messages, SCHEMA, keep=["i"]).collect()}
    assert typed == plain


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"Name":"Alex"}', ("Alex",)),
        ('{"Name":5}', ("5",)),
        ('{"Other":1}', (None,)),
        ('["a","b"]', (None,)),
        ('[{"Name":"x"},{"Name":"y"}]', (None,)),
        ("not json", (None,)),
        ("", None),
        (None, None),
        ('{"Name":"1","Name":"2"}', ("2",)),
        ('{"name":"lc"}', (None,)),
    ],
)
def test_declared_struct(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    data = parse_struct(df, T.StructType([T.StructField("Name", T.StringType())])).first()["data"]
    assert (data and tuple(data)) == expected


def test_corrupt_column_keeps_what_did_not_fit(spark):
    df = spark.createDataFrame([('{"k":1}',), ('{"k":"x"}',), ("junk",)], "value string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    rows = parse_struct(df, schema, corrupt="bad").collect()
    assert [(r["data"]["k"], r["bad"]) for r in rows] == [
        (1, None), (None, '{"k":"x"}'), (None, "junk"),
    ]


def test_bytes_that_are_not_text_are_malformed(spark):
    df = spark.createDataFrame([(b'{"a":"\xff"}',), (b'{"a":1}',)], "value binary")
    assert [r["status"] for r in parse_documents(df).collect()] == ["malformed", "stored"]


def test_field_of_another_type_is_null(spark):
    df = spark.createDataFrame([('{"k":"x"}',), ('{"k":7}',)], "value string")
    got = only_documents(df).select(document_field("doc", "$.k", "bigint").alias("k")).collect()
    assert [r["k"] for r in got] == [None, 7]


def test_repeated_keys_follow_the_session_setting(spark):
    configure(spark)
    df = spark.createDataFrame([('{"k":1,"k":2}',)], "value string")
    assert only_documents(df).select(document_field("doc", "$.k", "int").alias("k")).first()["k"] == 2


def test_schema_is_merged_over_all_objects(spark):
    texts = [
        '{"a b":1,"c":null,"d":{"x.y":[1]},"e":1.5,"h`i":true,"OBJECT":"VOID"}',
        '{"a b":2,"e":3,"c":null,"n":{},"g":[]}',
        "[1]", "junk", '{"mixed":1}', '{"mixed":"s"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = infer_schema(df)
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert types == {
        "a b": "bigint", "c": "string", "d": "struct<x.y:array<bigint>>", "e": "double",
        "g": "array<string>", "h`i": "boolean", "mixed": "variant", "n": "variant", "OBJECT": "string",
    }
    rows = apply_schema(df, schema).collect()
    assert len(rows) == 4
    assert sorted(r["e"] for r in rows if r["e"]) == [1.5, 3.0]


def test_first_object_can_decide_the_schema(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (0, "junk"), (2, '{"b":1}')], "o int, value string")
    assert infer_schema(df, sample=1, order_by=["o"]).fieldNames() == ["a"]
    assert infer_schema(df.where("o < 2"), sample=1).fieldNames() == ["a"]
    assert infer_schema(df, sample=5).fieldNames() == ["a", "b"]
    with pytest.raises(ValueError, match="use all"):
        infer_schema(df, sample=10**6)


def test_no_object_no_schema(spark):
    df = spark.createDataFrame([("junk",), ("[1]",), ("{}",)], "value string")
    with pytest.raises(ValueError, match="no JSON object"):
        infer_schema(df)


def test_a_stream_cannot_be_sampled(spark, folder):
    stream = spark.readStream.schema("value string").parquet(folder)
    with pytest.raises(ValueError, match="bounded read"):
        infer_schema(stream)


def test_only_structs_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a.b', 2, 'c', 3) AS data, array(1) AS l")
    assert flatten_struct(df, keep=["id"]).first().asDict() == {"id": 1, "a.b": 2, "c": 3}
    with pytest.raises(TypeError, match="only a struct"):
        flatten_struct(df, "l")


def test_names_that_are_data_become_a_map(spark):
    """20000 names below one field, others beside it: the type stays small and nothing is lost."""
    key = F.concat(F.lit("k/~"), F.col("id").cast("string"))
    value = F.concat(
        F.lit('{"id":'), F.col("id"), F.lit(',"by":{"'), key, F.lit('":{"n":'), F.col("id") * 2,
        F.lit(',"f":[1.5,2]},"null":null},"list":[{"a/b":'), F.col("id"), F.lit("}],\"none\":null,\"mixed\":"),
        F.when(F.col("id") % 2 == 0, "1").otherwise('"x"'), F.lit("}"),
    )
    messages = spark.range(20_000).select(value.alias("value"))
    schema = infer_schema(messages, most_keys=1000)
    assert schema.simpleString() == (
        "struct<by:map<string,struct<f:array<double>,n:bigint>>,id:bigint,list:array<struct<a/b:bigint>>,"
        "mixed:variant,none:string>"
    )
    rows = apply_schema(messages, schema)
    found = rows.select("id", F.explode("by").alias("k", "v")).filter("k <> 'null'")
    assert found.filter((F.col("k") != key) | (F.col("v.n") != 2 * F.col("id"))).count() == 0
    assert found.count() == 20_000
    with pytest.raises(ValueError, match="at the top"):
        infer_schema(spark.range(5000).select(F.format_string('{"%s":1}', F.col("id").cast("string")).alias("value")))


def test_types_with_maps_are_those_without(spark):
    """Where nothing is open, both ways of merging types agree."""
    from tidemark.operators import parsing

    cases = ['{"a":{"b":1,"c":[{"d":2},{"e":"x"}]}}', '{"a":{"b":1.5,"c":[]},"z":{}}', '{"a":null,"q":[[1],[2.5]],"t":true}']
    messages = spark.createDataFrame([(c,) for c in cases], "value string")
    objects = parsing.only_documents(messages)
    assert parsing.open_objects(objects) == set()
    assert parsing._type_with_maps(objects, "doc", set()) == infer_schema(messages)


@pytest.mark.parametrize("most_keys", [50, 1000])
def test_levels_do_not_multiply_the_reads_of_messages(spark, most_keys):
    """One pass over the messages for each level of nesting, whether or not names are data."""
    read = spark.sparkContext.accumulator(0)

    def made(batches):
        for batch in batches:
            read.add(batch.num_rows)
            values = [f'{{"a":[{{"b":{{"k{i}":{{"c":[{i}]}}}}}}]}}' for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values)], ["value"])

    schema = infer_schema(spark.range(200).mapInArrow(made, "value string"), most_keys=most_keys)
    inner = schema["a"].dataType.elementType["b"].dataType
    assert isinstance(inner, T.MapType if most_keys == 50 else T.StructType)
    levels = 7  # the document, a, its elements, b, the names below it, c, its elements
    assert read.value <= (levels + 1) * 200
