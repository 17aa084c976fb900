"""Every query of the subpackage that has SQL, beside that SQL."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

from tierflow.llm import queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    answer = duck.execute(queries.SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in answer.fetchall()]
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, want))
