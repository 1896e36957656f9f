"""Message values: bytes to text and back, suffixes, document wrapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two suffixes the original jobs append.
MESSAGE_SUFFIX = " Hello Spark!"
LINE_SUFFIX = " and hello spark"


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def decode_text(value: Column, strict: bool = False) -> Column:
    """Bytes as text.  ``strict`` turns bytes that are not valid UTF-8 into NULL."""
    text = value.cast("string")
    return F.try_validate_utf8(text) if strict else text


def text_bytes(value: Column) -> Column:
    """Any value as the UTF-8 bytes of its text form."""
    return value.cast("string").cast("binary")


def append_suffix(value: Column, suffix: str = MESSAGE_SUFFIX) -> Column:
    """Text with a suffix; NULL stays NULL."""
    return F.concat(value.cast("string"), F.lit(suffix))


def wrap_document(df: DataFrame, value: str = "value") -> DataFrame:
    """Each message as a one-field document ``message``, next to its topic."""
    return df.select("topic", decode_text(named(value)).alias("message"))
