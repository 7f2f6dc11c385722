"""Every registered query against its SQL in another engine, on the given tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from checks.oracle import ORACLE
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted((tuple(row[index] for index in order) for row in values), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, other_engine, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = other_engine.execute(ORACLE[name])
    expected_columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(expected_columns)
    got = rows(result.collect(), result.columns)
    wanted = rows(expected.fetchall(), expected_columns)
    assert len(got) == len(wanted)
    assert got
    for mine, other in zip(got, wanted, strict=True):
        assert [type(value) for value in mine] == [type(value) for value in other]
        assert mine == other or all(
            math.isclose(a, b, rel_tol=1e-15) if isinstance(a, float) else a == b
            for a, b in zip(mine, other, strict=True)
        )
