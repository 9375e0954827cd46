import duckdb
import pytest

import __spark_entry__ as contract
from tokenloom.plans.oracles import ORACLES
from tokenloom.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations events".split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_flagship(spark):
    assert contract.entry(spark).count() == 100


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = database.sql(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns) and len(found) == len(expected) > 0
    found, expected = (f[columns].sort_values(columns).reset_index(drop=True) for f in (found, expected))
    for column in columns:
        if found[column].dtype.kind == "f":
            assert ((found[column] - expected[column]).abs() <= 2e-6).all(), column
        else:
            assert (found[column].astype(str) == expected[column].astype(str)).all(), column
