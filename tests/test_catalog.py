"""Every query of the catalogue against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from eventloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, name):
    frame = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    theirs = sql.sql(catalog.SQL[name])
    assert sorted(theirs.columns) == columns
    at = [theirs.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in theirs.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
