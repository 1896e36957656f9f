"""Grouped counts.

All counts aggregate on the map side first, so a group that holds a third of
the rows sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import named


def kpi_count(df: DataFrame, *fields: str, count: str = "count") -> DataFrame:
    """Rows per combination of ``fields``; NULL is a group of its own.

    A field whose type differs between messages (``variant``) is grouped by its JSON text.
    """
    if not fields:
        raise ValueError("name at least one field to group by")
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}; there are {', '.join(df.columns)}")
    groups = [
        F.to_json(named(f)).alias(f) if isinstance(df.schema[f].dataType, T.VariantType) else named(f)
        for f in fields
    ]
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(count))


def kpi_totals(store: DataFrame, *fields: str, count: str = "count") -> DataFrame:
    """Totals over a store of per-batch counts."""
    return store.groupBy(*[named(f) for f in fields]).agg(F.sum(named(count)).alias(count))


def latest_kpi(
    store: DataFrame, *fields: str, count: str = "count", batch: str = "batch_id"
) -> DataFrame:
    """The last count of each group in a store of running counts."""
    return store.groupBy(*[named(f) for f in fields]).agg(
        F.max_by(named(count), named(batch)).alias(count)
    )


def produced_row_count(messages: DataFrame, source: str = "source_table") -> DataFrame:
    """Messages per source table."""
    return kpi_count(messages, source, count="n")
