"""The operators' queries against their SQL twins, on the smallest tables."""

import os

import duckdb
import pytest

from eventloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    with duckdb.connect() as connection:
        for file in os.listdir(FOLDER):
            connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
        theirs = connection.sql(queries.oracle_sql()[name])
        frame = queries.queries()[name](spark, FOLDER)
        assert sorted(theirs.columns) == sorted(frame.columns)
        at = [theirs.columns.index(c) for c in frame.columns]
        assert sorted(map(str, map(tuple, frame.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in theirs.fetchall())
