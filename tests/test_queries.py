import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, name, contract.queries()[name], contract.oracle_sql().get(name), SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
