"""JSON messages in three regimes: declared schema, inferred schema, no schema.

One topic may carry JSON objects, other JSON values and plain text, so each
parse keeps malformed input apart from missing fields.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import decode_text, named

STORED = "stored"  # a JSON object: can be stored as a document
NOT_DOCUMENT = "not_document"  # valid JSON, but an array or a scalar
MALFORMED = "malformed"  # not UTF-8, not JSON, empty or NULL

UNPARSED = "unparsed"  # an object by its first character, beyond the parser's limits
REST = "_rest"  # the variant column with objects that a typed table cannot hold whole

#: Bytes of a message and levels of nesting up to which the variant parser goes; longer
#: or deeper text is told apart from malformed text without building a document.
LARGEST_DOCUMENT = 16 << 20
DEEPEST_DOCUMENT = 1000

LARGEST_SAMPLE = 10_000  # a sample passes through the driver

#: An object with about this many names among all messages is taken for a map from
#: names to values, not for a record; levels below the deepest one are not looked at.
MOST_KEYS = 1000
DEEPEST_SCHEMA = 16

_JSON_SPACE = " \t\n\r"


def _text_of(df: DataFrame, value: str) -> Column:
    return decode_text(named(value), strict=True)


def _sealed(df: DataFrame, value: str) -> DataFrame:
    """Add the parsed ``[text, hash(text)]``.

    Spark's JSON parsers stop after the first complete value and would accept
    ``{"a":1} junk``.  The second element is only in place when the text is
    exactly one JSON value.
    """
    framed = df.withColumn("__text", _text_of(df, value)).withColumn(
        "__seal", F.xxhash64("__text")
    )
    return framed.withColumn("__parsed", _parsed())


def _parsed() -> Column:
    seal = F.col("__seal").cast("string")
    boxed = F.concat(F.lit("["), "__text", F.lit(","), seal, F.lit("]"))
    # Common encoders write these words for doubles that JSON has no literal
    # for.  The slower parser that knows them only runs where the other failed.
    words = F.col("__text").contains("NaN") | F.col("__text").contains("Infinity")
    lenient = F.from_json(boxed, "variant", {"allowSingleQuotes": "false"})
    return F.coalesce(F.try_parse_json(boxed), F.when(words, lenient))


def _is_json(parsed: Column) -> Column:
    seal = F.try_variant_get(parsed, "$[1]", "bigint")
    return F.coalesce(seal == F.col("__seal"), F.lit(False))


def _is_braced() -> Column:
    return F.substring(F.ltrim("__text", F.lit(_JSON_SPACE)), 1, 1) == "{"


def _beyond_parser() -> Column:
    """Whether a text may be too long or too deep for the parser, rather than broken."""
    opened = F.length(F.regexp_replace("__text", r"[^\[{]", ""))
    return (F.octet_length("__text") > LARGEST_DOCUMENT) | (opened > DEEPEST_DOCUMENT)


def parse_documents(
    df: DataFrame, value: str = "value", doc: str | None = "doc", status: str = "status"
) -> DataFrame:
    """Add ``status`` and, for objects, the parsed document ``doc`` (variant; None: leave out).

    A bad message is data, not an error: nothing here can fail a query.  The
    result comes out of a generator, because Spark would push a filter on it
    below a plain projection and parse every message twice.
    """
    of_json = F.when(_is_braced(), STORED).otherwise(NOT_DOCUMENT)
    other = F.when(_is_braced() & _beyond_parser(), UNPARSED).otherwise(MALFORMED)
    framed = _sealed(df, value).withColumn(
        "__status", F.when(_is_json(F.col("__parsed")), of_json).otherwise(other)
    )
    results = [F.col("__status").alias(status)]
    if doc is not None:
        parsed = F.try_variant_get("__parsed", "$[0]", "variant")
        results.append(F.when(F.col("__status") == STORED, parsed).alias(doc))
    found = F.array(F.struct(*results))
    kept = [named(c) for c in df.columns if c not in (status, doc)]
    return framed.select(*kept, found.alias("__found")).select(
        *kept, F.inline(_only_element("__found"))
    )


def only_documents(df: DataFrame, value: str = "value", doc: str = "doc") -> DataFrame:
    """The messages that are JSON objects, with the parsed document ``doc`` added.

    Same rows as ``parse_documents`` filtered on its status; here the
    generator itself leaves out the others.
    """
    document = F.array(F.try_variant_get("__parsed", "$[0]", "variant"))
    found = _sealed(df, value).withColumn(
        "__found", F.when(_is_json(F.col("__parsed")) & _is_braced(), document)
    )
    kept = [named(c) for c in df.columns if c != doc]
    return found.select(*kept, F.explode(_only_element("__found")).alias(doc))


def _only_element(array: str) -> Column:
    # Spark infers a filter from a generator over a plain column, and pushes it down.
    return F.slice(array, 1, 1)


def document_items(
    df: DataFrame,
    field: str,
    value: str = "value",
    out: str = "item",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per element (variant ``out``) of the array ``field`` of each JSON object."""
    items = F.try_variant_get("__parsed", f"$[0].{field}", "array<variant>")
    return _sealed(df, value).select(
        *[named(k) for k in keep or []],
        F.explode(F.when(_is_json(F.col("__parsed")) & _is_braced(), items)).alias(out),
    )


def document_field(doc: str, path: str, dtype: str) -> Column:
    """A field of a parsed document; NULL when absent or of another type."""
    return F.try_variant_get(doc, path, dtype)


def parse_struct(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    out: str = "data",
    corrupt: str | None = None,
) -> DataFrame:
    """Add ``out``: the message parsed to a declared struct.

    Malformed text and a missing field both give NULL fields; name a
    ``corrupt`` column to keep the raw text of what did not fit the schema.
    """
    if corrupt is None:
        return df.withColumn(out, F.from_json(_text_of(df, value), schema))
    full = T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType())])
    parsed = F.from_json(
        _text_of(df, value), full, {"columnNameOfCorruptRecord": "__corrupt", "mode": "PERMISSIVE"}
    )
    fields = [F.col("__parsed").getField(f.name).alias(f.name) for f in schema.fields]
    data = F.when(F.col("__parsed").isNotNull(), F.struct(*fields))
    left_out = F.col("__parsed").getField("__corrupt")
    kept = [named(c) for c in df.columns if c not in (out, corrupt)]
    found = df.withColumn("__parsed", parsed).select(
        *kept, F.array(F.struct(data.alias(out), left_out.alias(corrupt))).alias("__found")
    )
    # A generator, as in parse_documents: the result is there to be filtered on.
    return found.select(*kept, F.inline(_only_element("__found")))


_INFERRED_TYPE = re.compile(
    r"(?P<quoted>`(?:[^`]|``)*`)"
    r"|(?P<empty>OBJECT<>)"
    r"|(?P<object>OBJECT<)"
    r"|(?P<void>\bVOID\b(?!:))"
    r"|(?P<decimal>DECIMAL\((?P<precision>\d+), ?(?P<scale>\d+)\))"
)


def _as_ddl(inferred: str) -> str:
    """The inferred type of a variant, written as a DDL type.

    Fractions become ``double`` so that the scale seen so far does not bind
    later messages; a field that was only ever null becomes ``string``.
    """

    def rewrite(found: re.Match[str]) -> str:
        kind = found.lastgroup if found.lastgroup in ("quoted", "empty", "object", "void") else None
        if kind == "quoted":
            return found[0]
        if kind == "empty":
            return "VARIANT"
        if kind == "object":
            return "STRUCT<"
        if kind == "void":
            return "STRING"
        return "DOUBLE" if int(found["scale"]) else "DECIMAL(38,0)"

    return _INFERRED_TYPE.sub(rewrite, inferred)


# Steps of a path: names as in a JSON pointer, and two that stand for any name or element.
_ANY_NAME, _ELEMENT = "~n", "~e"


def _step(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def _name_of(step: str) -> str:
    return step.replace("~1", "/").replace("~0", "~")


def _nodes_below(nodes: DataFrame, open_paths: set[str]) -> DataFrame:
    """The members of objects and elements of arrays among ``nodes`` (``path``, ``v``), one row each.

    One generator makes both: a union would take the messages apart once for each side, and
    twice as often at every further level.
    """
    in_map = F.col("path").isin(*open_paths) if open_paths else F.lit(False)
    members = F.transform(
        F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")),
        lambda e: F.struct(e["key"].alias("name"), e["value"].alias("v")),
    )
    elements = F.transform(
        F.try_variant_get("v", "$", "array<variant>"),
        lambda e: F.struct(F.lit(None).cast("string").alias("name"), e.alias("v")),
    )
    step = F.when(F.col("name").isNull(), F.lit(_ELEMENT)).when(in_map, F.lit(_ANY_NAME)).otherwise(_step(F.col("name")))
    found = nodes.select("path", F.inline(F.coalesce(members, elements)))
    return found.select(F.concat_ws("/", "path", step).alias("path"), "v")


def _walk(objects: DataFrame, doc: str, open_paths: set[str], most_keys: int | None) -> dict[str, tuple]:
    """The kinds of nested values and the merged type of the others at each path, in one job for each level.

    With ``most_keys`` the paths of objects with more different names are added to ``open_paths`` on
    the way, before the level below them is read.
    """
    nodes = objects.select(F.lit("").alias("path"), F.col(doc).alias("v"))
    found: dict[str, tuple] = {}
    for level in range(DEEPEST_SCHEMA + 1):
        names = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
        given = nodes.select("path", "v", names.alias("names")).withColumn(
            "kind",
            F.when(F.col("names").isNotNull(), "object").when(
                F.try_variant_get("v", "$", "array<variant>").isNotNull(), "array"
            ),
        )
        results = [F.collect_set("kind").alias("kinds"), F.schema_of_variant_agg("scalar").alias("scalar")]
        counted = most_keys is not None and level < DEEPEST_SCHEMA
        if counted:
            results.append(F.approx_count_distinct("name").alias("n"))
        scalar = F.when(F.col("kind").isNull(), F.col("v")).alias("scalar")
        given = given.select("path", "kind", scalar, *[F.explode_outer("names").alias("name")] * counted)
        rows = given.groupBy("path").agg(*results).collect()
        found |= {r["path"]: (r["kinds"], r["scalar"]) for r in rows}
        if counted:
            open_paths |= {r["path"] for r in rows if r["n"] > most_keys}
        if not any(r["kinds"] for r in rows):
            break
        nodes = _nodes_below(nodes, open_paths)
    return found


def open_objects(objects: DataFrame, doc: str = "doc", most_keys: int = MOST_KEYS) -> set[str]:
    """Paths of the objects with more than ``most_keys`` different names, by a sketch of the names at each path.

    One job for each level of nesting; what comes to the driver are the paths of objects, whose
    number is bounded as names of open objects share one path.
    """
    found: set[str] = set()
    _walk(objects, doc, found, most_keys)
    return found


def _type_with_maps(objects: DataFrame, doc: str, open_paths: set[str]) -> T.DataType:
    """The merged type of all documents, in which objects at ``open_paths`` are maps."""
    return _built(_walk(objects, doc, open_paths, None), open_paths)


def _built(kinds: dict[str, tuple], open_paths: set[str]) -> T.DataType:
    """The type of what a walk found."""
    below: dict[str, list[str]] = {}
    for path in sorted(kinds):
        if path:
            below.setdefault(path.rpartition("/")[0], []).append(path)

    def build(path: str) -> T.DataType:
        nested, scalar = kinds[path]
        plain = scalar not in (None, "VOID")
        if len(nested) + plain > 1 or (nested and path.count("/") >= DEEPEST_SCHEMA):
            return T.VariantType()
        members = below.get(path, [])
        last = {m.rpartition("/")[2]: m for m in members}
        if nested == ["array"]:
            return T.ArrayType(build(last[_ELEMENT]) if _ELEMENT in last else T.VariantType())
        if nested:
            if path in open_paths:
                return T.MapType(T.StringType(), build(last[_ANY_NAME]))
            fields = [T.StructField(_name_of(step), build(m)) for step, m in sorted(last.items())]
            return T.StructType(fields) if fields else T.VariantType()
        return T.StructType.fromDDL(f"x {_as_ddl(scalar or 'VOID')}")["x"].dataType

    return build("")


def infer_schema(
    messages: DataFrame,
    value: str = "value",
    sample: int | None = None,
    order_by: list[str] | None = None,
    most_keys: int = MOST_KEYS,
) -> T.StructType:
    """The struct type of the JSON objects in a bounded read of a topic.

    By default every object counts: the types are merged in one aggregation
    with partial results on the map side, and only the type comes back.  With
    ``sample`` a handful of objects decide for all (1: the first one), in
    ``order_by`` order or as they are found, which reads no further than
    needed.  Fields whose types disagree become ``variant``.  A nested object with
    more than about ``most_keys`` names becomes a map from names to values, so the type
    stays bounded when names are data; at the top that is an error.
    """
    if messages.isStreaming:
        raise ValueError("infer the schema from a bounded read of the topic, not from the stream")
    objects = only_documents(messages, value)
    if sample is not None:
        if sample > LARGEST_SAMPLE:
            raise ValueError(f"a sample has up to {LARGEST_SAMPLE} objects; without it, use all")
        if order_by:
            objects = objects.orderBy(*[named(c) for c in order_by])
        texts = objects.select(_text_of(objects, value).alias("value")).limit(sample).collect()
        picked = messages.sparkSession.createDataFrame(texts, "value string")
        objects = only_documents(picked)
    else:
        found: set[str] = set()
        kinds = _walk(objects, "doc", found, most_keys)
        if "" in found:
            raise ValueError(f"more than {most_keys} names at the top of the objects: read them as documents")
        if found:
            return _built(kinds, found)
    inferred = objects.agg(F.schema_of_variant_agg("doc").alias("t")).first()["t"]
    if inferred is None or not inferred.startswith("OBJECT<") or inferred == "OBJECT<>":
        raise ValueError("no JSON object with fields to infer a schema from")
    return T.StructType.fromDDL(_as_ddl(inferred)[len("STRUCT<") : -1])


def flatten_struct(df: DataFrame, column: str = "data", keep: list[str] | None = None) -> DataFrame:
    """The fields of a struct column as top-level columns, after the ``keep`` columns."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{column} is {dtype.simpleString()}, only a struct can be flattened")
    fields = [named(column).getField(f.name).alias(f.name) for f in dtype.fields]
    return df.select(*[named(k) for k in keep or []], *fields)


def _sealed_structs(df: DataFrame, schema: T.StructType, value: str) -> tuple[DataFrame, Column]:
    """Parse the objects among the messages to ``schema``, normally in one parse.

    Returns the frame with the parse added and a column that holds, for an
    object, an array of its one struct, and NULL for any other message.  The
    text read is ``{"rows": [text, {"__seal": hash(text)}]}``, see ``_sealed``.
    Where the parser had to leave something out, it does not tell a field of
    another type from broken JSON; only those messages are checked again.
    """
    boxed = F.concat(
        F.lit('{"rows":['),
        "__text",
        F.lit(',{"__seal":'),
        F.col("__seal").cast("string"),
        F.lit("}]}"),
    )
    element = T.StructType([*schema.fields, T.StructField("__seal", T.LongType())])
    frame = T.StructType().add("rows", T.ArrayType(element)).add("__left_out", T.StringType())
    options = {"columnNameOfCorruptRecord": "__left_out", "allowSingleQuotes": "false"}
    framed = (
        df.withColumn("__text", _text_of(df, value))
        .withColumn("__seal", F.xxhash64("__text"))
        .withColumn("__read", F.from_json(boxed, frame, options))
    )
    rows = F.col("__read").getField("rows")
    first = F.get(rows, F.lit(0))
    sealed = (F.size(rows) == 2) & (F.get(rows, F.lit(1)).getField("__seal") == F.col("__seal"))
    # This parser also takes INF for a number, which other decoders do not.
    clean = F.col("__read").getField("__left_out").isNull() & ~F.col("__text").contains("INF")
    # It also takes longer texts than the document parser; both paths go by the latter.
    clean = clean & (F.octet_length("__text") <= LARGEST_DOCUMENT)
    is_object = F.when(clean, sealed & first.isNotNull()).otherwise(
        _is_json(_parsed()) & _is_braced()
    )
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in element.fields])
    return framed, F.when(is_object, F.array(F.coalesce(first, empty)))


def apply_schema(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] | None = None
) -> DataFrame:
    """Objects of a topic as typed columns; other messages do not become rows.

    The values are those of ``parse_struct``: a field that is absent or does
    not fit its type is NULL.
    """
    framed, objects = _sealed_structs(df, schema, value)
    kept = [named(k) for k in keep or []]
    found = framed.select(*kept, objects.alias("__found"))
    # A generator, not a filter: see parse_documents.
    return found.select(*kept, F.inline(_only_element("__found"))).drop("__seal")


def _path(name: str) -> str:
    quote = "'" if '"' in name else '"'
    return f"$[{quote}{name}{quote}]"


#: Types of JSON values that a column takes as they are; other columns go by the cast.
_FITTING = (
    (T.IntegralType, ("BIGINT",)),
    (T.DecimalType, ("BIGINT", "DECIMAL")),
    (T.FractionalType, ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")),
    (T.StringType, ("STRING",)),
    (T.BooleanType, ("BOOLEAN",)),
)


def _field_of(doc: str, field: T.StructField) -> tuple[Column, Column]:
    """The value of a typed field (NULL if it does not fit) and whether something did not fit."""
    path = _path(field.name)
    found = F.try_variant_get(doc, path, "variant")
    value = F.try_variant_get(doc, path, field.dataType.simpleString())
    kinds = next((k for t, k in _FITTING if isinstance(field.dataType, t)), None)
    if kinds:
        kind = F.schema_of_variant(found)
        value = F.when(reduce(Column.__or__, [kind.startswith(k) for k in kinds]), value)
    given = found.isNotNull() & ~F.is_variant_null(found)
    return value, F.coalesce(given & value.isNull(), F.lit(False))


def typed_messages(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: list[str] | None = None,
    rest: str | None = REST,
    others: bool = True,
) -> DataFrame:
    """Messages as typed columns, with nothing lost.

    Objects fill the columns of ``schema``; one with a field the schema does
    not have (names are compared by case), or with a value that does not fit,
    is also kept whole in the variant column ``rest``.  With ``others``
    every message is a row: ``_status`` says what it is, and ``_raw`` keeps
    the bytes of those that are no objects.
    """
    parsed = parse_documents(df, value, "__doc", "_status")
    if not others:
        parsed = parsed.where(F.col("_status") == STORED)
    fields = [(f.name, *_field_of("__doc", f)) for f in schema.fields]
    names = F.array(*[F.lit(n) for n in schema.fieldNames()]).cast("array<string>")
    unknown = F.size(F.array_except(F.json_object_keys(F.to_json("__doc")), names)) > 0
    unfit = reduce(Column.__or__, [bad for _, _, bad in fields], F.coalesce(unknown, F.lit(False)))
    columns = [named(k) for k in keep or []] + [v.alias(n) for n, v, _ in fields]
    if rest:
        columns.append(F.when(unfit, F.col("__doc")).alias(rest))
    if others:
        raw = F.when(F.col("_status") != STORED, named(value).cast("binary"))
        columns += [raw.alias("_raw"), F.col("_status")]
    return parsed.select(*columns)


def text_rows(
    df: DataFrame,
    field: str,
    value: str = "value",
    out: str = "item",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per inner array of the nested array ``field`` of each JSON object.

    Its elements come as text, fractions in their shortest form; about twice
    as fast as ``document_items``.
    """
    cells = T.ArrayType(T.ArrayType(T.StringType()))
    framed, objects = _sealed_structs(df, T.StructType([T.StructField(field, cells)]), value)
    items = F.get(objects, F.lit(0)).getField(field)
    return framed.select(*[named(k) for k in keep or []], F.explode(items).alias(out))
