"""What a whole run writes and moves: wide rows once, and only those that have to."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tallymart.operators import landing, ranking, validate
from tallymart.operators.shape import parse_events
from tallymart.plans import pipeline, queries
from tallymart.plans.pipeline import Config, ingest, load_orders, load_reference
from tallymart.plans.store import Store
from tallymart.session import cut_lineage, spread

NOW = datetime(2027, 5, 1, tzinfo=timezone.utc)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def order(name, **change):
    return {"order_id": name, "customer_id": "c1", "status": "placed", "channel": "web", "ordered_at": "2027-02-03T08:00:00Z",
            "items": [{"product_id": "p1", "quantity": 2, "unit_price": 3.5}], **change}


def opened(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,name,email,country,signup_date\nc1,C,c@post.test,SE,2020-02-29\n")
    (tmp_path / "p.csv").write_text("product_id,name,category,unit_cost,list_price\np1,P,Food,1,9\n")
    store = Store(spark, str(tmp_path / "tables"))
    store.init()
    config = Config(store.base, str(tmp_path / "c.csv"), str(tmp_path / "p.csv"), NOW)
    load_reference(store, config)
    return store, config


def send(store, at, *events):
    lines = store.spark.createDataFrame([(k, json.dumps(e)) for k, e in enumerate(events)], "position int, value string")
    return ingest(store, parse_events(lines), at)


def test_rows_of_many_files_stay_where_they_are(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for files in (1, cores):
        spark.range(1000).repartition(files).write.parquet(str(tmp_path / str(files)))
    few, many = (spark.read.parquet(str(tmp_path / str(n))) for n in (1, cores))
    assert "Exchange" in plan(spread(few)) and "Exchange" not in plan(spread(many))
    assert spread(few).count() == spread(many).count() == 1000


def test_only_rows_of_repeated_keys_are_compared(spark, monkeypatch):
    seen = []
    compare = ranking.latest_per_key
    monkeypatch.setattr(ranking, "latest_per_key", lambda df, *a: (seen.append(df.count()), compare(df, *a))[1])
    few = [(f"k{i}", i % 7, i) for i in range(400)] + [("k3", 9, 900), (None, 1, 901), (None, 2, 902), ("k5", None, 903)]
    many = [(f"k{i % 30}", i % 7, i) for i in range(400)]
    alone = [(f"k{i}", None, i) for i in range(50)] + [(None, 1, 51)]
    for rows, compared in ((few, [6]), (many, [400]), (alone, [])):
        table = cut_lineage(spark.createDataFrame(rows, "k string, n int, r long"))
        got = ranking.latest_where_repeated(table, ["k"], ["n"], row="r")
        assert seen == compared
        seen.clear()
        assert sorted(map(str, got.collect())) == sorted(map(str, compare(table, ["k"], ["n"], "r").collect()))
        assert got.columns == table.columns


def test_documents_sent_once_land_without_moving(spark):
    at = F.lit(NOW.isoformat()).cast("timestamp")
    sent = cut_lineage(spark.createDataFrame([(i, f"o{i}", "{}") for i in range(40)], "position int, order_id string, doc string"))
    batch = landing.newest_of_batch(sent, at)
    earlier = cut_lineage(landing.newest_of_batch(sent.filter("position < 30"), at - F.expr("interval 1 day")))
    fresh = landing.land(earlier.filter("false"), batch)
    assert "Exchange" not in plan(batch) and "Exchange" not in plan(fresh) and fresh.count() == 40
    both = landing.land(earlier, batch).groupBy(F.col("first_seen_at") < F.col("ingested_at")).count()
    assert dict(both.collect()) == {True: 30, False: 10}


def test_documents_are_read_behind_the_lookups(spark):
    texts = [json.dumps(order("a")), json.dumps(order("b", customer_id="x")), json.dumps(order("b", customer_id="x")), "", None, "{"]
    docs = spark.createDataFrame([(t,) for t in texts], "doc string")
    known = (spark.createDataFrame([("c1",)], "customer_id string"), spark.createDataFrame([("p1",)], "product_id string"))
    judged = validate.validate_order(docs, *known, NOW.isoformat(), text="doc")
    got = {(r.doc, r.reasons[0] if r.reasons else None) for r in judged.collect()}
    assert got == {(texts[0], None), (texts[1], "unknown customer x"), *[(t, "order_id is required") for t in ("", None, "{")]}
    assert {len(r.reasons) for r in judged.collect() if r.doc in ("", None, "{")} == {6}
    # Bottom up: the join comes first, then the text is parsed.
    steps = judged._jdf.queryExecution().analyzed().toString()
    assert steps.rindex("try_parse_json(") < steps.index("Join LeftOuter")


def test_a_load_writes_each_document_once(spark, tmp_path, monkeypatch):
    """Scratch tables with the text of the documents: one at the door, one of the judged orders,
    and the payload only where it is refused."""
    wide = []

    def watched(df, *args, **kwargs):
        table = cut_lineage(df, *args, **kwargs)
        if {"doc", "payload"} & set(df.columns):
            wide.append(table)
        return table

    for module in (pipeline, landing, ranking, validate):
        monkeypatch.setattr(module, "cut_lineage", watched, raising=False)
    store, config = opened(spark, tmp_path)
    wide.clear()
    send(store, NOW - timedelta(hours=2), *[order(f"o{k}", channel="fax" if k % 3 == 0 else "web") for k in range(30)])
    assert len(wide) == 1
    kept = []
    monkeypatch.setattr(store, "publish", lambda *a: kept.append([wide[-1].filter(c).count() for c in (
        "valid AND payload IS NOT NULL", "NOT valid AND lines IS NOT NULL", "NOT valid AND payload IS NOT NULL")]))
    assert load_orders(store, config) == {"read": 30, "loaded": 20, "rejected": 10}
    assert len(wide) == 2 and kept == [[0, 0, 10]]


def test_a_log_of_one_run_is_written_where_it_is(spark, tmp_path):
    store, config = opened(spark, tmp_path)
    send(store, NOW - timedelta(hours=2), order("a", channel="fax"), order("b"), order("b"), order("a", channel="fax"))
    load_orders(store, config)
    snap = store.snapshot()
    assert [(r.record_id, r.source) for r in snap.table("rejected_records").collect()] == [("a", "orders")]
    # Nothing was said twice of a record: its payload does not move to find what stands.
    assert "Exchange" not in plan(snap.table("rejected_records"))
    assert sorted(snap.parts("rejection_log")) == ["2", "4"]
    assert all(f.endswith(".zstd.parquet") for f in snap.table("rejection_log").inputFiles())


def test_events_of_a_whole_run_are_compressed(spark, tmp_path):
    rows = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "C", 0, "BUILDING")]),
        "nation": ("n_nationkey int, n_name string", [(0, "FRANCE")]),
        "part": ("p_partkey long, p_name string, p_type string, p_size int, p_retailprice double", [(1, "P", "PROMO", 5, 9.5)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp",
                   [(k, 1, "F", "2-HIGH", datetime(1995, 1, 2)) for k in (12, 13)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double", [(12, 2, 1, 4.0, 10.0, 0.1, 0.08), (12, 1, 1, 3.0, 10.0, 0.0, 0.0)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"in/{name}.parquet"))
    queries._write_sources(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    events = tmp_path / "out/events"
    assert list(events.glob("*.txt.gz")) and not list(events.glob("*.txt"))
    head = {"customer_id": "1", "status": "delivered", "channel": "web", "ordered_at": "1995-01-02T00:00:00Z"}
    assert sorted((json.loads(r.value) for r in spark.read.text(str(events)).collect()), key=lambda e: e["order_id"]) == [
        {"order_id": "12", **head, "items": [{"product_id": "1", "quantity": 3.0, "unit_price": 3.33},
                                             {"product_id": "1", "quantity": 4.5, "unit_price": -2.5}]},
        {"order_id": "13", **head, "items": []}]
