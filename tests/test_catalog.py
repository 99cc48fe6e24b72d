"""Every query that has SQL gives the same rows as DuckDB on the small tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tools.check_queries import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    _, text, good = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert good, text


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(ORACLE) <= set(QUERIES)
