"""Every registered query against its SQL on the smallest supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from kinfold import catalog
from tools.check_oracle import SAME, TABLES, canonical

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not there")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, con, name):
    result = catalog.QUERIES[name](spark, SF_DIR)
    relation = con.sql(catalog.ORACLES[name])
    types = {field.name: SAME.get(field.dataType.simpleString()) for field in result.schema}
    assert types == {column: str(kind) for column, kind in zip(relation.columns, relation.types)}
    assert canonical(result.toPandas()) == canonical(relation.df())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
