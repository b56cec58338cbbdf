"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from tests.compare import difference, duck

from stratalake import catalog

QUERIES = catalog.QUERIES
SQL = catalog.SQL


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert "client_sk" in df.columns
    assert df.count() > 0
