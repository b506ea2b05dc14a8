"""Queries that SQL can express, against SQL on the smallest tables."""

import os

import duckdb
import pytest

from tallymart.llm.queries import LLM_ORACLES, LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query(spark, engine, name):
    found = LLM_QUERIES[name](spark, FOLDER)
    asked = engine.execute(LLM_ORACLES[name])
    columns = [c[0] for c in asked.description]
    assert sorted(columns) == sorted(found.columns)
    at = sorted(columns)
    expected = sorted(repr([row[columns.index(c)] for c in at]) for row in asked.fetchall())
    assert sorted(repr([row[c] for c in at]) for row in found.collect()) == expected
