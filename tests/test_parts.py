"""What a load reads: filters of keys per part, buckets of orders, the log of rejections."""

import json
import os
from datetime import date, datetime, timedelta, timezone
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import functions as F

from tallymart.operators import key_filter
from tallymart.operators.keyed import current_rejections, rejection_entries
from tallymart.operators.shape import parse_events
from tallymart.plans import pipeline
from tallymart.plans.pipeline import Config, compact_rejections, ingest, load_orders, load_reference, parts_of_keys
from tallymart.plans.store import Rewrite, Store
from tallymart.plans.warehouse import build_warehouse

NOW = datetime(2027, 5, 1, tzinfo=timezone.utc)


def staged(spark, days, per_day=50):
    return spark.range(days * per_day).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.lit("c").alias("customer_id"),
        F.lit("placed").alias("status"), F.lit("web").alias("channel"),
        F.expr(f"timestamp'2027-01-01 10:00:00' + make_interval(0, 0, 0, cast(id div {per_day} as int))").alias("ordered_at"),
        F.lit(NOW.isoformat()).cast("timestamp").alias("loaded_at"),
    ).withColumn("order_date", F.to_date("ordered_at"))


def folders(frame):
    return {f.split("/part=")[1].split("/")[0] for f in frame.inputFiles()}


def test_only_parts_that_may_hold_a_key_are_read(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "t"), grain="day")
    snap = store.publish(store.init(), {"orders": Rewrite(staged(spark, 100))})
    assert len(snap.parts("orders")) == 100 and snap.filters("orders")[1] == set()
    batch = spark.createDataFrame([("o7",), ("o1203",), ("new",), (None,)], "order_id string")
    passed = key_filter.parts_that_may_hold(snap.filters("orders")[0], batch, ["order_id"])
    assert passed >= {"2027-01-01", "2027-01-25"} and len(passed) <= 3
    seen = []
    table = type(snap).table
    monkeypatch.setattr(type(snap), "table", lambda self, name, parts=None: (seen.append(parts), table(self, name, parts))[1])
    assert sorted(parts_of_keys(snap, "orders", batch, ["order_id"])) == [date(2027, 1, 1), date(2027, 1, 25)]
    assert [set(map(str, p)) for p in seen] == [passed]
    monkeypatch.undo()
    # A second version rewrites one part; old filters of that part no longer count.
    moved = snap.table("orders", [date(2027, 1, 1)]).filter("order_id <> 'o7'")
    after = store.publish(snap, {"orders": Rewrite(moved, [date(2027, 1, 1)])})
    assert len(after.parts("orders")) == 100
    assert parts_of_keys(after, "orders", batch, ["order_id"]) == [date(2027, 1, 25)]
    assert folders(after.table("orders", ["2027-01-25"])) == {"2027-01-25"}
    monkeypatch.setattr(key_filter, "MOST_KEYS", 2)
    assert key_filter.parts_that_may_hold(after.filters("orders")[0], batch, ["order_id"]) is None
    assert parts_of_keys(after, "orders", batch, ["order_id"]) == [date(2027, 1, 25)]
    assert parts_of_keys(store.publish(after, {"orders": Rewrite(staged(spark, 0))}), "orders", batch, ["order_id"]) == []


def test_filters_hold_every_key(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "SEGMENT_KEYS", 300)
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.expr("if(id < 4000, 'a', 'b')").alias("p"))
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([(None, "c")], "k string, p string"))
    filters = key_filter.build_filters(rows, ["k"], F.col("p")).cache()
    assert {r["segments"] for r in filters.filter("part = 'a'").collect()} == {32}  # repeated keys count
    for key, part in (("k17", "a"), ("k4321", "b"), (None, "c")):
        one = spark.createDataFrame([(key,)], "k string")
        assert part in key_filter.parts_that_may_hold(filters, one, ["k"])
    strange = spark.range(2000).select(F.concat(F.lit("x"), "id").alias("k"))
    hashes = strange.select(key_filter.key_hash(["k"])).toPandas().to_numpy().ravel()
    passed = 0
    for row in filters.filter("part = 'a'").collect():
        own, bits = hashes[hashes % row["segments"] == row["segment"]], np.frombuffer(row["bits"], np.uint8)
        for probe in range(key_filter.PROBES):
            at = key_filter._place(own, probe, 8 * len(bits))
            own = own[np.unpackbits(bits)[at] == 1]
        passed += len(own)
    assert passed <= 4


def order(name, day, **change):
    return {"order_id": name, "customer_id": "c1", "status": "placed", "channel": "web",
            "ordered_at": f"2027-{day}T08:00:00Z", "items": [{"product_id": "p1", "quantity": 2, "unit_price": 3.5}], **change}


def send(store, at, *events):
    lines = store.spark.createDataFrame([(k, json.dumps(e)) for k, e in enumerate(events)], "position int, value string")
    return ingest(store, parse_events(lines), at)


def opened(spark, tmp_path, **layout):
    (tmp_path / "c.csv").write_text("customer_id,name,email,country,signup_date\nc1,C,c@post.test,SE,2020-02-29\n")
    (tmp_path / "p.csv").write_text("product_id,name,category,unit_cost,list_price\np1,P,Food,1,9\n")
    store = Store(spark, str(tmp_path / "tables"), **layout)
    store.init()
    config = Config(store.base, str(tmp_path / "c.csv"), str(tmp_path / "p.csv"), NOW)
    load_reference(store, config)
    return store, config


def bytes_of(frame):
    return sum(os.path.getsize(unquote(urlparse(f).path)) for f in frame.inputFiles())


def test_a_correction_reads_its_buckets_only(spark, tmp_path):
    store, config = opened(spark, tmp_path, buckets=8)
    names = [f"o{k}" for k in range(300)]
    send(store, NOW - timedelta(hours=2), *[order(n, "02-03" if k % 2 else "03-09") for k, n in enumerate(names)])
    load_orders(store, config)
    build_warehouse(store)
    before = store.snapshot()
    assert len(before.parts("order_items")) == 16 and set(before.parts("orders")) == set(before.parts("fact_order_items"))
    one = spark.createDataFrame([("o8",)], "order_id string")
    parts = parts_of_keys(before, "orders", one, ["order_id"])
    assert len(parts) == 1
    assert 6 * bytes_of(before.table("order_items", parts)) < bytes_of(before.table("order_items"))
    send(store, NOW - timedelta(hours=1), order("o8", "03-09", items=[{"product_id": "p1", "quantity": 9, "unit_price": 1}]))
    load_orders(store, config, since=NOW - timedelta(minutes=90))  # past the overlap with the first batch
    after = store.snapshot()
    assert {p for p, f in after.parts("order_items").items() if before.parts("order_items")[p] != f} == set(parts)
    assert build_warehouse(store) == {"fact_rows": 300, "parts_rebuilt": 1}
    assert [r.quantity for r in store.snapshot().table("fact_order_items").filter("order_id = 'o8'").collect()] == [9]
    again = Store(spark, store.base)
    try:
        again.snapshot()
        raise AssertionError("another layout was accepted")
    except ValueError:
        pass


def test_a_load_reads_no_earlier_rejection(spark, tmp_path, monkeypatch):
    store, config = opened(spark, tmp_path)
    changes = []
    change = pipeline._rejection_change
    monkeypatch.setattr(pipeline, "_rejection_change", lambda *a: changes.append(change(*a)) or changes[-1])
    send(store, NOW - timedelta(hours=3), order("a", "02-01", status="lost"), order("b", "02-01", channel="fax"), order("c", "02-01"))
    load_orders(store, config, since=datetime(1970, 1, 1))
    first = store.snapshot()
    send(store, NOW - timedelta(hours=2), order("a", "02-01"), order("d", "02-02", customer_id="nobody"))
    load_orders(store, config)
    after = store.snapshot()
    assert not any("rejection_log" in f for c in changes for f in c.rows.inputFiles())
    kept = {p: f for p, f in after.parts("rejection_log").items() if p in first.parts("rejection_log")}
    assert kept == first.parts("rejection_log")

    def standing(snap):
        return {(r.record_id, tuple(r.reasons)) for r in snap.table("rejected_records").collect()}

    assert standing(first) == {("a", ("unknown status lost",)), ("b", ("unknown channel fax",))}
    assert standing(after) == {("b", ("unknown channel fax",)), ("d", ("unknown customer nobody",))}
    assert compact_rejections(store, runs=100) > 1
    assert compact_rejections(store, runs=1) == 1
    assert standing(store.snapshot()) == standing(after)
    assert "rejected_records" in store.snapshot()


def test_log_of_rejections(spark):
    def run(number, accepted, refused):
        return rejection_entries(
            "s", spark.createDataFrame([(x,) for x in accepted], "record_id string"),
            spark.createDataFrame([("s", x, [r], "{}") for x, r in refused],
                                  "source string, record_id string, reasons array<string>, payload string"),
            F.lit("2027-01-01").cast("timestamp"), number)

    log = run(1, ["a", "a"], [("b", "r1"), ("c", "r1")]).unionByName(
        run(2, ["b", "c"], [("c", "r2")])).unionByName(run(10, [], [("d", "r3"), ("a", "r3")]))
    assert {(r.record_id, r.reasons[0]) for r in current_rejections(log).collect()} == {("c", "r2"), ("d", "r3"), ("a", "r3")}
