"""Orders that are read in one go give what reading them field by field gives."""

import json

from pyspark.sql import functions as F

from tallymart.operators import shape, validate
from tallymart.operators.once import with_columns_once

NOW = "2026-06-15T12:00:00Z"
NUMBERS = [
    "0", "1", "7.0", "-0.0", "-3", "34.5", "1.25", "1.255", "1.2550", "1.2500", "1.25000", "2147483647", "2147483648",
    "99999999.99", "99999999.999", "99999999.9999", "100000000", "100000000.01", "100000000.001", "99999999999999.5",
    "999999999999999", "9223372036854775807", "92233720368547758070", "1e2", "1.5e0", "12345678901234567890.1234", "null",
]
ITEM = '{"product_id": " jam\\u0085", "quantity": %s, "unit_price": %s}'
ORDER = '{"order_id":" a ","customer_id":"lena\\u2003","status":" PLACED","channel":"Web","ordered_at":"2026-02-03","items":[%s]}'
DOCS = (
    [ORDER % (ITEM % (n, n)) for n in NUMBERS]
    + [ORDER % ", ".join([ITEM % (1, n), ITEM % (n, 2.5)]) for n in NUMBERS]
    + [ORDER % x for x in ("", "null", "null, " + ITEM % (1, 2), '{"quantity": 1}, ' + ITEM % (1, 2), "[1], 3")]
)


def by_fields(monkeypatch, run):
    """`run` with no order counted as a usual one."""
    with monkeypatch.context() as patch:
        patch.setattr(validate, "usual_order",
                      lambda event, typed: F.when(F.lit(False), shape.usual_order(event, typed)))
        return run()


def test_both_ways_of_reading_agree(spark, monkeypatch):
    parsed = shape.parse_events(spark.createDataFrame([(d,) for d in DOCS], "doc string"), "doc")
    known = spark.createDataFrame([("lena",)], "customer_id string"), spark.createDataFrame([], "product_id string")

    def judged():
        rows = validate.read_orders(parsed).drop("event").collect()
        rows += validate.validate_order(parsed, *known, NOW, text="doc").drop("event").collect()
        return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in rows)

    assert judged() == by_fields(monkeypatch, judged)


def test_usual_orders_are_found(spark):
    parsed = shape.parse_events(spark.createDataFrame([(d,) for d in DOCS[:5]], "doc string"), "doc")
    read = with_columns_once(parsed, {"usual": shape.usual_order(F.col("event"), typed=True)})
    assert read.filter("usual IS NULL").count() == 0


def test_the_payload_is_left_out_where_nobody_reads_it(spark):
    parsed = shape.parse_events(spark.createDataFrame([(DOCS[0],)], "doc string"), "doc")
    known = spark.createDataFrame([("lena",)], "customer_id string"), spark.createDataFrame([("jam",)], "product_id string")
    judged = validate.validate_order(parsed, *known, NOW, text="doc").select("order_id", "reasons")
    assert "to_json" not in judged._jdf.queryExecution().optimizedPlan().toString()
