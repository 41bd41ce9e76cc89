"""Registered queries against their SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from segue.plans import oracle, queries

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "lineitem", "part", "embeddings"]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def normalized(frame):
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted(map(tuple, frame.values.tolist()), key=repr)


# Queries of optional parts are tested with those.
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = queries.queries()[name](spark, SF).toPandas()
    want = con.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalized(got) == normalized(want)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["track_uri", "playlist_count", "popularity_rank"]
    assert df.count() > 0
