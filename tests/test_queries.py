"""Every registered query against its checking statement, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from almoner.plans.catalog import QUERIES
from almoner.plans.oracle import ORACLE
from check import TABLES, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, db, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), db.execute(ORACLE[name]).df()) == []


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["layer", "col", "row", "value"] and not entry(spark).isEmpty()
