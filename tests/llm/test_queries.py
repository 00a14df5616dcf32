"""The queries of the training-data operators against their SQL on the smallest driver tables."""

import os

import duckdb
import pytest

from shelfmark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, duck, name):
    run, sql = QUERIES[name]
    df = run(spark, SF_DIR)
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == expected and expected


def test_only_models_and_tokens_are_without_sql():
    """These are tested against brute force, libraries or held-out rows beside their operators."""
    assert {n for n, (_, sql) in QUERIES.items() if not sql} == {
        "op1_bpe", "op3_toxicity", "op4_packing", "op8_lm_scoring", "op12_language_id", "op13_whitening", "pipeline",
    }
