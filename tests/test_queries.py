"""Every registered query but those of the training-data operators against its SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from bindings import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: run for name, (run, _) in registry.all_queries().items()}
SQL = {name: sql for name, (_, sql) in registry.all_queries().items() if sql is not None}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def canonical(rows):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(plain(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert canonical(got) == canonical(expected)
    assert got


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
