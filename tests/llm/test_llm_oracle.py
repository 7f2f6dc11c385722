"""Every query for training data that has SQL, against that SQL in another engine."""

from __future__ import annotations

import math

import duckdb
import pytest

from tillbook.llm.oracle import ORACLE
from tillbook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def close(a, b):
    if isinstance(a, list):
        return len(a) == len(b) and all(map(close, a, b))
    return math.isclose(a, b, rel_tol=1e-15) if isinstance(a, float) else a == b


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    expected = connection.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(result.columns)
    got = sorted((tuple(row) for row in result.select(*columns).collect()), key=repr)
    wanted = sorted(expected.fetchall(), key=repr)
    assert len(got) == len(wanted) > 0
    for mine, other in zip(got, wanted, strict=True):
        assert [type(value) for value in mine] == [type(value) for value in other]
        assert all(map(close, mine, other)), (mine, other)
