"""Every query against its SQL in a second engine.

CLIMCUBE_SF_DIR chooses the data; the default is the smallest set.
"""

import os

import pytest

import __spark_entry__ as entry_point
from climcube.workload.oracle import statements
from climcube.workload.queries import registry
from compare import difference, duck

SF_DIR = os.environ.get("CLIMCUBE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry()
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_entry_returns_rows(spark):
    df = entry_point.entry(spark)
    assert df.columns[:4] == ["variable", "experiment", "region", "year"]
    assert len(df.collect()) > 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None
