"""Every registered query against its SQL in DuckDB, on the same tables."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracle import oracle
from tidemark.plans.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'"
        )
    return connection


def _plain(value):
    return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(registered()) == set(oracle())
    assert set(registered()) <= set(contract.queries())
    assert set(oracle()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_result(spark, duck, sf_dir, name):
    result = registered()[name](spark, sf_dir)
    expected = duck.execute(oracle()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    ours = _bag(result.columns, [tuple(r) for r in result.collect()])
    theirs = _bag(columns, expected.fetchall())
    assert sum(theirs.values()) > 0
    missing, extra = theirs - ours, ours - theirs
    assert not missing and not extra, (list(missing.items())[:3], list(extra.items())[:3])


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["k", "count"]
    assert sum(r["count"] for r in result.collect()) == 1000
