"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracles import ORACLES
from tallymart.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows, columns, wanted):
    positions = [columns.index(c) for c in wanted]
    return sorted((tuple(r[i] for i in positions) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_names_match():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_names_without_training_data(monkeypatch):
    """Neither subpackage nor pipeline: the pipeline's file alone must not be imported."""
    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda name: None if name.startswith("tallymart.llm") else True)
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    found = QUERIES[name](spark, FOLDER)
    expected = engine.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(found.columns)
    wanted = sorted(columns)
    assert ordered(found.collect(), found.columns, wanted) == ordered(
        expected.fetchall(), columns, wanted)


def test_oversized_orders_are_refused_by_count(spark, engine):
    """With a lower limit: no event and no line of theirs, but a refusal each."""
    from tallymart.sources.bridge_docs import order_events, oversized_orders

    sizes = dict(engine.execute("""
        SELECT o_orderkey, count(l_orderkey) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY 1""").fetchall())
    events = order_events(spark, FOLDER, most_items=3).selectExpr(
        "position", "json_array_length(get_json_object(value, '$.items')) AS n")
    assert {r["position"]: r["n"] for r in events.collect()} == {k: n for k, n in sizes.items() if n <= 3}
    refused = oversized_orders(spark, FOLDER, most_items=3).collect()
    assert {r["position"] for r in refused} == {k for k, n in sizes.items() if n > 3}
    assert {r["errors"][0] for r in refused} == {"items: Array must contain at most 200 element(s)"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
