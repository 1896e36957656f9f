"""Table rows as text: ISO timestamps, JSON arrays, JSON objects, single cells.

Every expression is built from the schema when the plan is made and runs
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import named

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
_TIMES = (*_TIMESTAMPS, T.TimeType)
_PLAIN_NUMBERS = (T.IntegralType, T.DecimalType, T.BooleanType)


def _iso_text(value: Column, dtype: T.DataType, with_zone: bool = True) -> Column:
    # The cast drops trailing zeros; ISO text has either no fraction or six digits.
    text = F.replace(value.cast("string"), F.lit(" "), F.lit("T"))
    dot = F.instr(text, ".")
    text = F.when(dot > 0, F.rpad(text, dot + 6, F.lit("0"))).otherwise(text)
    if with_zone and isinstance(dtype, T.TimestampType):
        text = F.concat(text, F.date_format(value, "xxx"))
    return text


def _holds_timestamp(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_timestamp(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_timestamp(dtype.keyType) or _holds_timestamp(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_holds_timestamp(f.dataType) for f in dtype.fields)
    return isinstance(dtype, _TIMES)


def iso_value(value: Column, dtype: T.DataType, with_zone: bool = True) -> Column:
    """``value`` with every timestamp and time of day inside it, at any depth, as ISO-8601 text."""
    if not _holds_timestamp(dtype):
        return value
    if isinstance(dtype, _TIMES):
        return _iso_text(value, dtype, with_zone)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: iso_value(item, dtype.elementType, with_zone))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(
            F.transform(
                F.map_entries(value),
                lambda entry: F.struct(
                    iso_value(entry["key"], dtype.keyType, with_zone).alias("key"),
                    iso_value(entry["value"], dtype.valueType, with_zone).alias("value"),
                ),
            )
        )
    fields = [
        iso_value(value.getField(f.name), f.dataType, with_zone).alias(f.name)
        for f in dtype.fields
    ]
    return F.when(value.isNotNull(), F.struct(*fields))


def iso_timestamps(
    df: DataFrame, columns: Iterable[str] | None = None, with_zone: bool = True
) -> DataFrame:
    """Replace the timestamps in ``columns`` (default: all) by ISO-8601 text.

    No fraction when it is zero, six digits otherwise.  Instants (``timestamp``)
    carry the session offset, so that two of them never read alike when clocks
    change, unless ``with_zone`` is off; local times never get one.
    """
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            (iso_value(named(f.name), f.dataType, with_zone) if f.name in chosen else named(f.name))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _json_cell(value: Column, dtype: T.DataType) -> Column:
    """One value as JSON text; SQL NULL becomes ``null``."""
    if isinstance(dtype, _PLAIN_NUMBERS):
        text = value.cast("string")
    elif isinstance(dtype, T.FractionalType):
        text = value.cast("string")
        # JSON has no literal for these three.
        text = F.when(text.isin("NaN", "Infinity", "-Infinity"), _quoted(text)).otherwise(text)
    elif isinstance(dtype, _TIMES):
        text = _quoted(_iso_text(value, dtype))
    elif isinstance(dtype, T.DateType):
        text = _quoted(value.cast("string"))
    elif isinstance(dtype, T.VariantType):
        text = F.to_json(value)
    else:
        # Strings and nested values: the serialiser escapes them, the brackets come off.
        boxed = F.to_json(F.array(iso_value(value, dtype)), {"ignoreNullFields": "false"})
        return F.substring(boxed, F.lit(2), F.length(boxed) - 2)
    return F.coalesce(text, F.lit("null"))


def row_json_array(df: DataFrame) -> Column:
    """The whole row as one positional JSON array, without column names."""
    cells = [_json_cell(named(f.name), f.dataType) for f in df.schema.fields]
    return F.concat(F.lit("["), F.concat_ws(", ", *cells), F.lit("]"))


def row_json_object(df: DataFrame) -> Column:
    """The whole row as one JSON object ``{"column": value}``; NULLs are kept."""
    fields = [iso_value(named(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def row_cells(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Each row cell by cell in column order: ``keys``, ``pos``, ``cell`` (as text)."""
    cells = F.array(*[named(c).cast("string") for c in df.columns])
    return df.select(*[named(k) for k in keys], F.posexplode(cells).alias("pos", "cell"))
