"""Every rule case as one row: the changed record and the exact list of reasons."""

import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.operators import shape, validate

NOW = "2026-06-15T12:00:00Z"


def item(**changes):
    return {"product_id": "jam", "quantity": 6, "unit_price": 3.25, **changes}


def order(**changes):
    return {
        "order_id": "basket/7", "customer_id": "lena", "status": "SHIPPED", "channel": "store",
        "ordered_at": "2026-02-03T04:05:06Z",
        "items": [item(), {"product_id": "rye", "quantity": 1, "unit_price": " 0.80 "}],
        **changes,
    }


QUANTITY = "item 1: quantity must be a positive integer"
PRICE = "item 1: unit_price must be a non-negative amount"
LARGE = "item 1: unit_price must be below 100000000"
# One changed field at a time, fields in the order of the contract.
FIELDS = [
    ("order_id", " ", "order_id is required"),
    ("customer_id", "otto", "unknown customer otto"),
    ("customer_id", 12, "unknown customer (empty)"),
    ("status", "lost at sea", "unknown status lost at sea"),
    ("channel", "", "unknown channel (empty)"),
    ("ordered_at", "soon", "ordered_at is not a valid timestamp"),
    ("ordered_at", "2026-02-31T00:00:00Z", "ordered_at is not a valid timestamp"),
    ("ordered_at", None, "ordered_at is not a valid timestamp"),
    ("ordered_at", "2031-01-01T00:00:00+14:00", "ordered_at is in the future"),
    ("items", [], "an order needs at least one item"),
]
LINES = [
    (dict(product_id="ash"), ["item 1: unknown product ash"]),
    *[(dict(quantity=q), [QUANTITY]) for q in (0, -6, 0.5, "6", True, None, 2**31, 1.00000000001)],
    *[(dict(quantity=q), []) for q in (2**31 - 1, 4.0)],
    *[(dict(unit_price=p), [PRICE]) for p in (-0.01, 3.251, False, None, "cheap")],
    *[(dict(unit_price=p), []) for p in (0, "3.250", 99_999_999.99)],
    *[(dict(unit_price=p), [LARGE]) for p in (100_000_000, "1e9")],
    (dict(product_id="ash", quantity=-1, unit_price="x"), ["item 1: unknown product ash", QUANTITY, PRICE]),
]
CASES = [
    (order(), []),
    *[(order(**{name: value}), [reason]) for name, value, reason in FIELDS],
    *[(order(items=[item(**changes)]), reasons) for changes, reasons in LINES],
    (order(items=[item(), item(product_id="ash")]), ["item 2: unknown product ash"]),
    (order(items=[item()] * 3), ["item 2: product jam listed twice", "item 3: product jam listed twice"]),
    (order(items=[[], item(product_id="\t")]), ["item 1: not an object", "item 2: unknown product (empty)"]),
    ({}, ["order_id is required", "unknown customer (empty)", "unknown status (empty)",
          "unknown channel (empty)", "ordered_at is not a valid timestamp",
          "an order needs at least one item"]),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(CASES)]
    events = shape.parse_events(spark.createDataFrame(rows, "position int, value string"))
    customers = spark.createDataFrame([("lena",)], "customer_id string")
    products = spark.createDataFrame([("jam",), ("rye",)], "product_id string")
    result = validate.validate_order(events, customers, products, NOW)
    return {r.position: r for r in result.collect()}


def test_every_order_case(judged):
    assert {i: r.reasons for i, r in judged.items()} == {
        i: reasons for i, (_, reasons) in enumerate(CASES)
    }


def test_valid_order_is_typed(judged):
    row = judged[0]
    assert (row.order_id, row.status, row.ordered_at) == (
        "basket/7", "shipped", datetime(2026, 2, 3, 4, 5, 6))
    assert [(x.product_id, x.quantity, x.unit_price) for x in row.lines] == [
        ("jam", 6, D("3.25")), ("rye", 1, D("0.80"))]
    assert json.loads(row.payload)["status"] == "SHIPPED"


def test_missing_id_is_marked(judged):
    assert judged[len(CASES) - 1].record_id == "?"


def check_values(spark, rule, cases):
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    found = {r.t: r.x for r in rows.select("t", rule(F.col("t")).alias("x")).collect()}
    assert found == cases


def test_money(spark):
    check_values(spark, v.money, {
        "1.990": D("1.99"), "1.999": None, "1e2": D("100"), ".5": D("0.5"), "+5": D("5"),
        "-0": D("0"), "-1": None, "NaN": None, "abc": None, "": None, "1.00000000001": None,
        "1.00000000001e0": None, "100e-4": D("0.01"), "1e-3": None, "99999999.99": D("99999999.99"),
        "100000000": None, "5.": D("5"), "1e": None, "+": None, "Infinity": None,
    })


def test_moment(spark):
    check_values(spark, v.moment, {
        "2026-06-01": datetime(2026, 6, 1), "2026-06-01 09:30": datetime(2026, 6, 1, 9, 30),
        "2026-06-01T09:30:00": datetime(2026, 6, 1, 9, 30),
        "2026-06-01T09:30:00+02:00": datetime(2026, 6, 1, 7, 30),
        "2026-06-01T09:30:00-0530": datetime(2026, 6, 1, 15),
        "2026-06-01T09:30:00.5Z": datetime(2026, 6, 1, 9, 30, 0, 500000),
        "yesterday": None, "now": None, "2026": None, "09:30": None, "2026-13-01": None,
        "2026-02-30T00:00:00Z": None,
    })


def test_date(spark):
    check_values(spark, v.iso_date, {
        "2025-11-02": date(2025, 11, 2), "2025-13-40": None, "2025-1-1": None, "2025-01": None,
        "2025-01-10T00:00": None, "": None,
    })


def test_trim_is_unicode_aware(spark):
    check_values(spark, v.trimmed, {"  a b\t": "a b", " x　": "x", "\x1cy\n": "y", "": ""})


def test_customers(spark):
    rows = spark.createDataFrame(
        [("\tlena ", "Lena Aho", "LENA@mail.test", "FI", "2019-12-31"),
         ("otto", " ", "otto@mail", "", "31.12.2019")],
        "customer_id string, name string, email string, country string, signup_date string")
    good, bad = sorted(validate.validate_customer(rows).collect(), key=lambda r: r.record_id)
    assert (good.customer_id, good.email, good.signup_date, good.reasons) == (
        "lena", "lena@mail.test", date(2019, 12, 31), [])
    assert bad.reasons == ["name is required", "email is not valid", "country is required",
                           "signup_date must be YYYY-MM-DD"]
    assert json.loads(bad.payload) == {"customer_id": "otto", "name": " ", "email": "otto@mail",
                                       "country": "", "signup_date": "31.12.2019"}


def test_products(spark):
    prices = {"3.25": [], "100000000": ["list_price must be below 100000000"]}
    prices |= {p: ["list_price must be a non-negative amount"] for p in ("", "dear", "-0.5", "NaN", "0.125")}
    rows = spark.createDataFrame(
        [(f"sku{i}", "Jam", "Food", "0.90", p) for i, p in enumerate(prices)],
        "product_id string, name string, category string, unit_cost string, list_price string")
    found = sorted(validate.validate_product(rows).collect(), key=lambda r: r.product_id)
    assert found[0].list_price == D("3.25")
    assert [r.reasons for r in found] == list(prices.values())


SHAPES = [
    (order(items=[item()]), []),
    (order(customer_id="otto", items=[item(quantity=-3)]), []),
    (order(items=[]), []),
    ({"order_id": "basket/8", "extra": 1},
     ["customer_id: Required", "status: Required", "channel: Required", "ordered_at: Required",
      "items: Required", "order: Unrecognized key(s) in object: 'extra'"]),
    (order(order_id="  ", items=[item()]),
     ["order_id: String must contain at least 1 character(s)"]),
    (order(order_id="x" * 65, items=[item()]),
     ["order_id: String must contain at most 64 character(s)"]),
    (order(order_id="\U0001f600" * 33, items=[item()]),
     ["order_id: String must contain at most 64 character(s)"]),
    (order(status=5, items=[item(quantity="2", note="x")]),
     ["status: Expected string, received number", "items.0.quantity: Expected number, received string",
      "items.0: Unrecognized key(s) in object: 'note'"]),
    (order(items=[None, []]),
     ["items.0: Expected object, received null", "items.1: Expected object, received array"]),
    (order(items=[item()] * 201), ["items: Array must contain at most 200 element(s)"]),
    ([1], ["order: Expected object, received array"]),
]


def test_shapes(spark):
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(SHAPES)] + [
        (98, json.dumps(order(items=[item()]))[:-1] + ', "order_id": "basket/9"}'), (99, "{broken")]
    events = shape.parse_events(spark.createDataFrame(rows, "position int, value string"))
    accepted, refused = shape.check_shape(events)
    assert {r["index"]: r.errors for r in refused.collect()} == {
        **{i: errors for i, (_, errors) in enumerate(SHAPES) if errors},
        99: ["Body is not valid JSON"],
    }
    kept = {r.position: r for r in accepted.collect()}
    assert sorted(kept) == [0, 1, 2, 98]
    assert kept[98].order_id == "basket/9"  # of a repeated key the last one counts
    assert json.loads(kept[0].doc)["items"] == [item()]
