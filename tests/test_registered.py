"""Registered queries against their SQL in another engine, on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as contract
from skyledger.oracle import all_sql
from skyledger.queries import all_queries

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "DATE": "date",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(contract.queries()) and set(all_sql()) <= set(contract.oracle_sql())


def test_flagship(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_sql(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    cursor = database.execute(contract.oracle_sql()[name])
    types = {column[0]: TYPES[str(column[1])] for column in cursor.description}
    assert dict(result.dtypes) == types
    order = [list(types).index(column) for column in result.columns]
    expected = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(row) for row in result.collect()), key=repr) == expected
