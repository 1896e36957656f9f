"""Many tables into one topic."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rowtext import row_json_array, row_json_object

ROW_FORMATS = {"object": row_json_object, "array": row_json_array}


def tables_to_topic(tables: Mapping[str, DataFrame], row_format: str = "object") -> DataFrame:
    """The rows of all ``tables`` as messages: ``source_table``, ``value``.

    One plan scans all tables side by side; nothing is shuffled and nothing
    is deduplicated.
    """
    if not tables:
        raise ValueError("no tables given")
    serialise = ROW_FORMATS[row_format]
    parts = [
        table.select(F.lit(name).alias("source_table"), serialise(table).alias("value"))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
