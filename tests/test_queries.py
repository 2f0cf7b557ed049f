"""Every registered query against its oracle on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.run import TABLES, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_oracle(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    result = db.execute(contract.oracle_sql()[name])
    theirs = normal([d[0] for d in result.description], result.fetchall())
    assert normal(df.columns, df.collect()) == theirs


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
