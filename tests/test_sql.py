"""Every query that has SQL gives the same rows as DuckDB on the smallest tables."""

import duckdb
import pytest

from corpusmill.plans.queries import QUERIES, SQL
from tests.compare import TABLES, rows_of

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, DIR)
    theirs = duck.sql(SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert rows_of(map(tuple, ours.select(*columns).collect())) == rows_of(theirs.select(*[f'"{c}"' for c in columns]).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).limit(5).collect()
