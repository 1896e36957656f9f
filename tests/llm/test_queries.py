"""Registered queries against their SQL, and what their names promise."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.llm.oracle import oracle
from tidemark.llm.queries import registered


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(
        tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    )


@pytest.mark.parametrize("name", sorted(oracle()))
def test_same_result(spark, duck, sf_dir, name):
    result = registered()[name](spark, sf_dir)
    expected = duck.execute(oracle()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    theirs = _bag(columns, expected.fetchall())
    assert theirs and _bag(result.columns, [tuple(r) for r in result.collect()]) == theirs


def test_every_operator_is_registered():
    found = contract.queries()
    assert {int(n[2:].split("_")[0]) for n in found if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in found
    assert set(oracle()) <= set(found)
