"""Paged query results: JSON envelopes ``{"columns": [...], "data": [[...], ...]}``."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rowtext import row_json_array
from tidemark.functions.values import named
from tidemark.operators.parsing import document_items, only_documents, text_rows

# Type names of result envelopes that Spark spells differently.
_TYPE_NAMES = {
    "varchar": "string",
    "char": "string",
    "json": "string",
    "uuid": "string",
    "integer": "int",
    "real": "float",
    "varbinary": "binary",
}


def result_pages(
    df: DataFrame, rows_per_page: int = 1000, bytes_per_page: int = 8 << 20
) -> DataFrame:
    """The rows of ``df`` as envelope messages: ``body``, ``n_rows``.

    A page holds consecutive rows of one task, at most ``rows_per_page`` of
    them and, unless it is a single row, at most ``bytes_per_page`` of row
    text.  So no row moves between tasks and no page grows with the table.
    Rows become JSON text in the JVM; per Arrow batch, only the joining of
    those texts into page bodies is left to vectorised Arrow calls, because
    any grouping operator would shuffle the whole table.
    """
    if rows_per_page < 1:
        raise ValueError("rows_per_page must be positive")
    columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]
    opening = '{"columns":' + json.dumps(columns, ensure_ascii=False) + ',"data":['

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, comma, tail, none = (
            pa.scalar(text, pa.large_string()) for text in (opening, ", ", "]}", "")
        )
        for batch in batches:
            rows = batch.column(0).cast(pa.large_string())
            ends = np.cumsum(pc.binary_length(rows).to_numpy())
            first = 0
            while first < len(rows):
                room = bytes_per_page + (ends[first - 1] if first else 0)
                fitting = int(np.searchsorted(ends, room, side="right"))
                page = rows.slice(first, min(rows_per_page, max(1, fitting - first)))
                joined = pc.binary_join(
                    pa.ListArray.from_arrays(pa.array([0, len(page)], pa.int32()), page), comma
                )
                body = pc.binary_join_element_wise(head, joined, tail, none)
                yield pa.RecordBatch.from_arrays(
                    [body.cast(pa.string()), pa.array([len(page)], pa.int32())],
                    names=["body", "n_rows"],
                )
                first += len(page)

    return df.select(row_json_array(df).alias("row")).mapInArrow(bodies, "body string, n_rows int")


def _arguments(text: str) -> list[str]:
    """The parts of a list of types, cut at commas outside brackets."""
    parts, depth = [""], 0
    for letter in text:
        depth += (letter == "(") - (letter == ")")
        if letter == "," and not depth:
            parts.append("")
        else:
            parts[-1] += letter
    return [p.strip() for p in parts]


def _spark_type(name: str) -> str:
    """The DDL type for a type name of a result envelope, nested types included."""
    nested = re.fullmatch(r"\s*(array|map|row)\s*\((.*)\)\s*", name, re.DOTALL | re.IGNORECASE)
    if nested:
        kind, parts = nested[1].lower(), _arguments(nested[2])
        if kind != "row":
            return f"{kind}<{','.join(map(_spark_type, parts))}>"
        fields = []
        for i, part in enumerate(parts):
            found = re.fullmatch(r'("(?:[^"]|"")*"|[A-Za-z_]\w*)\s+(.+)', part, re.DOTALL)
            own, dtype = (found[1].strip('"'), found[2]) if found else (f"field{i}", part)
            fields.append(f"`{own}`:{_spark_type(dtype)}")
        return f"struct<{','.join(fields)}>"
    name = name.strip().lower()
    if re.match(r"timestamp\b.*with time zone$", name):
        return "timestamp"
    if name.startswith("timestamp("):
        return "timestamp_ntz"
    if re.match(r"time\b", name):
        return "string"
    base = re.sub(r"\(.*\)$", "", name)
    if base in _TYPE_NAMES:
        return _TYPE_NAMES[base]
    return name


_COLUMNS = "array<struct<name:string,type:string>>"


def _as_schema(columns: list) -> T.StructType:
    return T.StructType(
        [T.StructField(c["name"], T.DataType.fromDDL(_spark_type(c["type"]))) for c in columns]
    )


def page_schema(pages: DataFrame, body: str = "body") -> T.StructType:
    """The row schema named in the ``columns`` of one stored page."""
    columns = only_documents(pages.select(named(body)), body).select(
        F.try_variant_get("doc", "$.columns", _COLUMNS).alias("c")
    )
    found = columns.where(F.col("c").isNotNull()).limit(1).first()
    if found is None:
        raise ValueError("no page names its columns")
    return _as_schema(found["c"])


def page_schemas(pages: DataFrame, body: str = "body", most: int = 1000) -> dict[str, T.StructType]:
    """The schemas of all result sets in a folder, by the ``header`` that ``pages_with`` takes."""
    headers = pages.select(_header(pages, body).alias("h")).where("h IS NOT NULL").distinct()
    found = [r["h"] for r in headers.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} result sets; select some of their pages first")
    return {h: _as_schema(json.loads(h)) for h in sorted(found)}


def _header(pages: DataFrame, body: str) -> Column:
    columns = F.try_variant_get(F.try_parse_json(named(body)), "$.columns", _COLUMNS)
    return F.to_json(columns)


def pages_with(pages: DataFrame, header: str, body: str = "body") -> DataFrame:
    """The pages of one result set."""
    return pages.where(_header(pages, body) == F.lit(header))


# Types whose JSON text casts back to the same value.  Decimals are not among
# them: a text parse takes fractions through a double.
_TEXT_TYPES = (
    T.StringType,
    T.IntegralType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BinaryType,
)


def flatten_pages(
    pages: DataFrame,
    schema: T.StructType,
    body: str = "body",
    keep: list[str] | None = None,
    unfit: str | None = None,
) -> DataFrame:
    """Every row of every page as typed columns of ``schema``, by position.

    A page without ``data`` (still running) has no rows.  Bodies that are
    not JSON objects give none either; find them with ``parse_documents``.
    A cell that does not fit its declared type is NULL; the column ``unfit``
    then holds the JSON text of the row, as it does for a row that has more
    or fewer cells than the schema.  Pages of several result sets are told
    apart by ``page_schemas`` and ``pages_with``.
    """
    as_text = all(isinstance(f.dataType, _TEXT_TYPES) for f in schema.fields)
    rows = (text_rows if as_text else document_items)(pages, "data", body, "__row", keep)

    def given(position: int) -> Column:
        if as_text:
            return F.get("__row", F.lit(position))
        found = F.try_variant_get("__row", f"$[{position}]", "variant")
        return F.when(~F.is_variant_null(found), found)

    def cell(position: int, dtype: T.DataType) -> Column:
        if as_text:
            text = F.get("__row", F.lit(position))
            return F.try_to_binary(text, F.lit("base64")) if isinstance(dtype, T.BinaryType) else text.try_cast(dtype)
        if isinstance(dtype, T.BinaryType):
            text = F.try_variant_get("__row", f"$[{position}]", "string")
            return F.try_to_binary(text, F.lit("base64"))
        return F.try_variant_get("__row", f"$[{position}]", dtype.simpleString())

    cells = [cell(i, f.dataType) for i, f in enumerate(schema.fields)]
    named_cells = [c.alias(f.name) for c, f in zip(cells, schema.fields, strict=True)]
    if unfit is not None:
        n = F.size("__row") if as_text else F.size(F.try_variant_get("__row", "$", "array<variant>"))
        wrong = n != len(cells)
        for i, c in enumerate(cells):
            wrong = wrong | (given(i).isNotNull() & c.isNull())
        named_cells.append(F.when(wrong, F.to_json("__row")).alias(unfit))
    return rows.select(*[named(k) for k in keep or []], *named_cells)
