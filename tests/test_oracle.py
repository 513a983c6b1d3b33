"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from corbel.plans import catalogue
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
OWN = set(catalogue.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) > 0


def test_every_query_has_an_oracle():
    assert not OWN - set(ORACLES)


@pytest.mark.parametrize("name", ["cat_table", "cat_transfer"])
def test_no_database_is_left(spark, name):
    before = spark.catalog.listDatabases()
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0 and spark.catalog.listDatabases() == before


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 3 + 3 + 63 + 3 + 9 and df.count() > 0
