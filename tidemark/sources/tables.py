"""SQL tables and text files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def split_name(name: str, parts: int | tuple[int, ...] = (2, 3)) -> list[str]:
    """``schema.table`` or ``catalog.schema.table`` in its parts; any other shape is an error."""
    allowed = (parts,) if isinstance(parts, int) else parts
    found = name.split(".")
    if len(found) not in allowed or not all(found):
        wanted = " or ".join(str(n) for n in allowed)
        raise ValueError(f"{name!r}: a table name has {wanted} parts")
    return found


def qualified_scan(spark: SparkSession, name: str) -> DataFrame:
    """A table by its qualified name; catalogs come from ``spark.sql.catalog.*``."""
    parts = split_name(name)
    return spark.table(".".join("`" + p.replace("`", "``") + "`" for p in parts))


def first_line(error: Exception) -> str:
    """What went wrong, in one line; for an error of a driver or catalog, its own message."""
    if isinstance(error, Py4JJavaError):
        return str(error.java_exception.toString()).splitlines()[0]
    return (str(error).splitlines() or [type(error).__name__])[0]


def resolve_tables(
    spark: SparkSession, names: Iterable[str]
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The tables that can be read, and the reason for each one that cannot, whatever failed."""
    found: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            found[name] = qualified_scan(spark, name)
        except (PySparkException, Py4JJavaError, ValueError) as error:
            failed[name] = first_line(error)
    return found, failed


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str | int,
    upper: str | int,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A remote table, fetched by many tasks over ranges of ``partition_column``.

    The bounds only place the ranges; rows outside them are read as well.
    Choose a column whose values are spread evenly.  Credentials and the
    driver class go into ``options``.  Timestamps without a zone stay so.
    """
    defaults = {"preferTimestampNTZ": "true", "fetchsize": "10000"}
    return (
        spark.read.format("jdbc")
        .options(**{**defaults, **(options or {})})
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", partitions)
        .load()
    )


def text_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """One row per line, blank lines included, in ``value``.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r`` unless ``line_sep`` names the separator.
    """
    return spark.read.text(path, lineSep=line_sep)
