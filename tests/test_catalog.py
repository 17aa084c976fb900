"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.check import compare, connect

from tierflow import catalog

SQL = catalog.SQL
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_names():
    assert set(SQL) <= set(NAMES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not [n for n in NAMES if re.match(r"op\d+_", n) or n == "pipeline"]


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toArrow()
    if name in SQL:
        verdict = compare(got, duck.sql(SQL[name]).to_arrow_table())
        assert verdict.startswith("ok"), verdict
    else:
        assert got.num_rows > 0
