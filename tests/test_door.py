"""The door judges every event once, however it is written."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallymart.operators import shape
from tallymart.plans.pipeline import ingest
from tallymart.plans.store import Rewrite, Store

NOON = datetime(2027, 3, 1, 12, tzinfo=timezone.utc)
GOOD = {"product_id": " fig ", "quantity": 2, "unit_price": 1.50}


def event(**changes):
    usual = {"order_id": " k1\t", "customer_id": "ada", "status": "placed", "channel": "web",
             "ordered_at": "2027-02-28T10:00:00Z", "items": [GOOD, {**GOOD, "quantity": 2.5}]}
    return {k: v for k, v in {**usual, **changes}.items() if v != "gone"}


USUAL = [event(), event(items=[]), event(items=[{**GOOD, "unit_price": 1e300}]), event(status="é" * 16)]
OTHER = [
    event(items=[GOOD, None]), event(items=[None]), event(items=[GOOD, {**GOOD, "quantity": None}]),
    event(items=[GOOD, {"product_id": "fig", "quantity": 1}]), event(items=[GOOD, {**GOOD, "more": 1}]),
    event(items=[{**GOOD, "quantity": "2"}, GOOD]), event(items=[{**GOOD, "product_id": 7}]),
    event(items=[GOOD, []]), event(items={}), event(items="gone"), event(items=None), event(status=None),
    event(channel=1), event(extra="x"), event(order_id="gone"), [event()], None, 3,
]
LONG = [event(order_id=" ﻿"), event(status="x" * 33), event(items=[GOOD] * 201), event(ordered_at="\U0001f600" * 21),
        event(items=[{**GOOD, "product_id": "p" * 65}])]


def parsed(spark, events):
    rows = [(i, json.dumps(e, ensure_ascii=False)) for i, e in enumerate(events)]
    return shape.parse_events(spark.createDataFrame(rows, "position long, value string"))


def test_usual_orders_are_told_from_others(spark):
    found = parsed(spark, USUAL + LONG + OTHER).select("position", shape.usual_order(F.col("event")).isNotNull())
    assert {i for i, usual in found.collect() if usual} == set(range(len(USUAL + LONG)))


def test_usual_orders_keep_their_document_and_others_their_errors(spark):
    accepted, refused = shape.check_shape(parsed(spark, USUAL + LONG + OTHER))
    slow = parsed(spark, USUAL).select("position", shape.trimmed_document(F.col("event")))
    assert {r.position: r.doc for r in accepted.collect()} == dict(slow.collect())
    assert {r.order_id for r in accepted.collect()} == {"k1"}
    assert {r["index"] for r in refused.collect()} == set(range(len(USUAL), len(USUAL + LONG + OTHER)))


def test_door_reads_each_event_once(spark, tmp_path):
    """One evaluation per event until the batch is published."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    lines = parsed(spark, USUAL + OTHER).select("position", "value").repartition(2)
    store = Store(spark, str(tmp_path / "door"))
    store.init()
    events = shape.parse_events(lines.select("position", counted.asNondeterministic()("value").alias("value")))
    ingest(store, events, NOON)
    assert seen.value == len(USUAL + OTHER)
    assert store.snapshot().table("refused_events").count() == len(OTHER)


def test_arrivals_of_one_day_are_written_where_they_are(spark, tmp_path):
    store = Store(spark, str(tmp_path / "door"))
    rows = spark.range(90).repartition(3).select(
        F.col("id").cast("string").alias("position"), F.array(F.lit("no")).alias("errors"), F.lit("{").alias("text"),
        F.lit("2027-03-01 12:00:00").cast("timestamp").alias("refused_at"), F.lit("2027-03-01").cast("date").alias("refused_date"))
    snap = store.publish(store.init(), {"refused_events": Rewrite(rows, [datetime(2027, 3, 1).date()])})
    table = snap.table("refused_events")
    assert list(snap.parts("refused_events")) == ["2027-03-01"] and table.count() == 90
    assert len(table.inputFiles()) == 3  # nothing was gathered into one
