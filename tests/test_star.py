"""Export, measures, stream, files and tables."""

import json
from dataclasses import replace
from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.operators.keyed import assign_keys
from tallymart.operators.quality import FailedChecks
from tallymart.plans import export as ex
from tallymart.plans import marts, measures, reports
from tallymart.plans.pipeline import Config, ingest_files, load_reference, run_all
from tallymart.plans.star import describe_days
from tallymart.plans.store import Rewrite, StaleSnapshot, Store
from tallymart.sources.files import parts_since, read_reference
from tallymart.streaming.orders import stream_orders

NOW = datetime(2026, 6, 1, 12, tzinfo=timezone.utc)


def event(order_id, customer, status, channel, at, *items):
    return json.dumps({
        "order_id": order_id, "customer_id": customer, "status": status, "channel": channel,
        "ordered_at": at,
        "items": [dict(product_id=p, quantity=q, unit_price=u) for p, q, u in items]})


BACK = ("tea", 1, 3.5)
EVENTS = [
    event("north", "juri", "shipped", "mobile", "2025-11-28T08:30:00Z", ("kettle", 1, 45.0)),
    event("south", "ida", "delivered", "store", "2025-12-01T17:45:00Z", ("kettle", 1, 40.0), ("tea", 3, 4.0)),
    event("west", "ida", "returned", "web", "2025-12-03T23:59:00Z", BACK),
]


def write_inputs(folder):
    (folder / "customers.csv").write_text(
        "customer_id,name,email,country,signup_date\n"
        "ida,\"Moss, Ida\",ida@mail.test,NO,2024-05-06\njuri,Juri,juri@mail.test,EE,2024-06-07\n")
    (folder / "products.csv").write_text(
        "product_id,name,category,unit_cost,list_price\nkettle,Kettle,Kitchen,20.00,45.00\n"
        "tea,Green tea,Food,1.50,4.00\n")
    (folder / "events").mkdir()
    (folder / "events" / "a.json").write_text("\n".join(EVENTS) + "\n")
    return Config(str(folder / "base"), str(folder / "customers.csv"),
                  str(folder / "products.csv"), NOW)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("export")
    config = write_inputs(folder)
    store = Store(spark, config.base)
    store.init()
    ingest_files(store, str(folder / "events"), NOW)
    run_all(store, config)
    return store, folder


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*order).collect()]


def test_export_and_reload(shop):
    store, folder = shop
    star = store.snapshot().star()
    for _ in range(2):  # a second export replaces the first
        counts = ex.export(star, str(folder / "out"), "run1")
    assert counts == {"dim_date": 6, "dim_customer": 2, "dim_product": 2, "fact_order_items": 4}
    text = "".join(p.read_text() for p in (folder / "out/run=run1/fact_order_items").glob("*.json"))
    first = json.loads(text.splitlines()[0])
    assert (first["revenue"], first["order_date"]) == ("45.00", "2025-11-28")
    after = ex.load(store, str(folder / "out"), "run1", counts)
    copy = ex.loaded_star(after)
    assert [r[0] for r in rows(copy.fact_order_items.select("revenue"), "revenue")] == [
        D("3.50"), D("12.00"), D("40.00"), D("45.00")]
    assert set(after.parts("loaded_fact_order_items")) == {"2025-11-28", "2025-12-01", "2025-12-03"}
    for name, mart in marts.MARTS.items():
        assert rows(mart(copy), *mart(copy).columns[:3]) == rows(mart(star), *mart(star).columns[:3]), name


def pruned(frame, column):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return any(column in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])


def test_a_filter_on_the_day_reads_its_folder_only(shop, spark):
    store, folder = shop
    star = store.snapshot().star()
    ex.export(star, str(folder / "days"), "run1")
    loaded = ex.load(store, str(folder / "days"), "run1").table("loaded_fact_order_items")
    by_day = ex.load_days(spark, str(folder / "days"), "run1", str(folder / "by_day"))
    for copy in (loaded, by_day):
        one = copy.filter("order_date = DATE'2025-12-01'")
        assert pruned(one, "order_date") and {str(r.order_date) for r in one.collect()} == {"2025-12-01"}
    # One day is sent again; the others keep their files.
    kept = {f for f in by_day.inputFiles() if "2025-12-01" not in f}
    again = star.fact_order_items.filter("order_date = DATE'2025-12-01'").withColumn("quantity", F.lit(77))
    ex.export(replace(star, fact_order_items=again), str(folder / "days"), "run2")
    after = ex.load_days(spark, str(folder / "days"), "run2", str(folder / "by_day"))
    assert kept < set(after.inputFiles()) and after.count() == star.fact_order_items.count()
    assert {r.quantity for r in after.filter("order_date = DATE'2025-12-01'").collect()} == {77}


def test_reload_reports_a_gap(shop):
    store, folder = shop
    counts = ex.export(store.snapshot().star(), str(folder / "gap"), "run1")
    with pytest.raises(FailedChecks, match="loaded_rows_fact_order_items"):
        ex.load(store, str(folder / "gap"), "run1", {**counts, "fact_order_items": 5})


def test_bad_or_null_exported_value_fails(shop, spark):
    _, folder = shop
    target = folder / "bad/run=r/dim_product"
    target.mkdir(parents=True)
    good = dict(product_key=1, product_id="P", name="n", category="c", unit_cost="1.00", list_price="2.00")
    only = {"dim_product": schemas.EXPORTS["dim_product"]}
    for wrong in ({"unit_cost": "x"}, {"name": None}):
        (target / "a.json").write_text(json.dumps({**good, **wrong}))
        with pytest.raises(Exception):
            ex.read_export(spark, str(folder / "bad"), "r", only)["dim_product"].collect()


def test_no_mail_leaves(shop):
    store, _ = shop
    star = store.snapshot().star()
    frames = {**ex.export_frames(star), **ex.snapshot_frames(star)}
    assert not any("email" in f.columns for f in frames.values())
    assert ex.check_contract(ex.snapshot_frames(star)) == []
    assert ex.check_contract({"dim_date": star.dim_date.drop("month")})[0].startswith("dim_date")


def test_csv_snapshot(shop, spark):
    store, folder = shop
    ex.export_csv(store.snapshot().star(), str(folder / "csv"))
    back = read_reference(spark, str(folder / "csv/dim_customer"))
    assert ("1", "ida", "Moss, Ida", "NO", "2024-05-06") in rows(back.drop("_order"), "customer_id")
    days = read_reference(spark, str(folder / "csv/dim_date"))
    assert days.filter("year_month = '2025-12'").count() == 3


def test_missing_target():
    with pytest.raises(ValueError):
        ex.export(None, "")


def test_monthly(shop):
    store, _ = shop
    assert rows(reports.report_monthly_revenue(store.snapshot().table("monthly_revenue")), "year_month") == [
        ("2025-11", 1, 1, 45.0, 25.0, 55.56), ("2025-12", 1, 4, 52.0, 27.5, 52.88)]


@pytest.mark.parametrize("limit", [0, 101, "abc", 2.5, True])
def test_top_products_limit(limit):
    with pytest.raises(ValueError):
        reports.report_top_products(None, limit)


def test_measures(shop):
    star = shop[0].snapshot().star()
    total = measures.measure(star, list(measures.NEEDS)).first()
    assert total["Revenue"] == D("97.00") and total["Orders"] == 2
    assert total["Return Rate"] == 1 / 3 and total["Customers"] == 2
    by_month = rows(measures.measure(
        star, ["Revenue", "Daily Revenue", "Revenue Previous Month"], ["dim_date.year_month"]), "year_month")
    assert by_month[0][:2] == ("2025-11", D("45.00")) and by_month[0][2] == 15.0
    # Days move back by a month each; the calendar holds none of 1 to 3 November.
    assert by_month[1] == ("2025-12", D("52.00"), 52 / 3, None)
    with pytest.raises(ValueError):
        measures.measure(star, ["Revenue"], ["fact_order_items.status"])
    returned = measures.measure(star, ["Return Rate"], ["fact_order_items.status"])
    assert {r.status: r["Return Rate"] for r in returned.collect()} == {"shipped": 0.0, "delivered": 0.0, "returned": 1.0}
    mobile = measures.measure(star, ["Revenue", "Customers"],
                              where={"fact_order_items.channel": lambda c: c == "mobile"}).first()
    assert (mobile["Revenue"], mobile["Customers"]) == (D("45.00"), 2)
    norway = measures.measure(star, ["Customers"], where={"dim_customer.country": lambda c: c == "NO"})
    assert norway.first()["Customers"] == 1


def test_blank_measure_is_null(shop):
    star = shop[0].snapshot().star()
    none = measures.measure(star, ["Margin %", "Revenue"],
                            where={"fact_order_items.channel": lambda c: c == "pigeon"}).first()
    assert none["Margin %"] is None and none["Revenue"] is None


def test_stream_equals_batch(shop, spark, tmp_path):
    config = write_inputs(tmp_path)
    store = Store(spark, config.base)
    store.init()
    load_reference(store, config)
    for _ in range(2):  # the second start finds nothing new
        query = stream_orders(store, config, str(tmp_path / "events"), str(tmp_path / "progress"))
        query.awaitTermination()
    for table in ("orders", "order_items"):
        batch = shop[0].snapshot().table(table)
        assert rows(store.snapshot().table(table), "order_id", batch.columns[1]) == rows(
            batch, "order_id", batch.columns[1])
    version = store.snapshot().version
    (tmp_path / "events" / "b.json").write_text(
        event("west", "ida", "delivered", "web", "2025-12-03T23:59:00Z", BACK))
    stream_orders(store, config, str(tmp_path / "events"), str(tmp_path / "progress")).awaitTermination()
    assert store.snapshot().version > version
    assert store.snapshot().table("orders").filter("order_id = 'west'").first().status == "delivered"


def test_failed_run_leaves_the_old_version(shop):
    store, _ = shop
    snap = store.snapshot()
    broken = snap.table("dim_product").withColumn("name", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        store.publish(snap, {"dim_customer": Rewrite(snap.table("dim_customer").limit(0)),
                             "dim_product": Rewrite(broken)})
    assert store.snapshot().version == snap.version
    assert store.snapshot().table("dim_customer").count() == 2


def test_second_writer_is_refused(shop):
    store, _ = shop
    old = store.snapshot()
    store.publish(old, {})
    with pytest.raises(StaleSnapshot):
        store.publish(old, {})


def test_keys_are_stable(spark):
    dim = spark.createDataFrame([(4, "b", "old")], "k long, id string, name string")
    updates = spark.createDataFrame([("a", "x"), ("b", "new"), ("c", "y")], "id string, name string")
    assert rows(assign_keys(dim, updates, "id", "k"), "k") == [
        (4, "b", "new"), (5, "a", "x"), (6, "c", "y")]


def test_calendar_golden(spark):
    days = spark.createDataFrame([(date(2026, 4, 4),), (date(2026, 10, 1),)], "full_date date")
    assert rows(describe_days(days), "date_key") == [
        (20260404, date(2026, 4, 4), 2026, 2, 4, "April", 6, True),
        (20261001, date(2026, 10, 1), 2026, 4, 10, "October", 4, False)]


def test_segment_rule(spark):
    scores = spark.createDataFrame(
        [(4, 3, 3, "champion"), (4, 4, 2, "loyal"), (3, 2, 1, "loyal"), (4, 1, 4, "new"),
         (2, 1, 3, "at risk"), (1, 4, 4, "at risk"), (3, 1, 4, "occasional"), (2, 4, 2, "occasional")],
        "r int, f int, m int, want string")
    found = scores.select("want", marts.segment(F.col("r"), F.col("f"), F.col("m")).alias("got"))
    assert found.filter("want <> got").count() == 0


def test_quoted_newlines_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,"two\nlines","say ""hi"""\n2,short\n', encoding="utf-8-sig")
    path = str(tmp_path / "a.csv")
    assert rows(read_reference(spark, path).drop("_order"), "id") == [
        ("1", "two\nlines", 'say "hi"'), ("2", "short", None)]


def test_last_valid_row_wins_and_rejection_stays(spark, tmp_path):
    config = write_inputs(tmp_path)
    with open(config.customers, "a") as handle:
        handle.write("ida,Ida Fjord,fjord@mail.test,NO,2024-05-06\nida,,bad,NO,2024-05-06\n")
    store = Store(spark, config.base)
    store.init()
    assert load_reference(store, config) == {"customers": 2, "products": 2, "rejected": 1}
    snap = store.snapshot()
    assert snap.table("customers").filter("customer_id = 'ida'").first().name == "Ida Fjord"
    assert snap.table("rejected_records").first().reasons == ["name is required", "email is not valid"]


def test_parts_since_the_watermark():
    parts = ["2026-01-01", "2026-02-01", "2026-03-01"]
    days = [date.fromisoformat(p) for p in parts]
    assert parts_since(parts, None) == days
    assert parts_since(parts, datetime(2026, 2, 20)) == days[1:]
    assert parts_since(parts, datetime(2026, 3, 1, 0, 4)) == days[1:]  # the overlap reaches back
    assert parts_since(parts, datetime(2026, 3, 1, 0, 6)) == days[2:]
    assert parts_since(parts, datetime(2025, 5, 5)) == days
    assert parts_since([], datetime(2025, 5, 5)) == []


def test_two_streams_and_a_new_checkpoint(spark, tmp_path):
    """Every stream counts its own batches; refused lines are kept."""
    config = write_inputs(tmp_path)
    store = Store(spark, config.base)
    store.init()
    load_reference(store, config)

    def run(folder, checkpoint):
        stream_orders(store, config, str(tmp_path / folder), str(tmp_path / checkpoint)).awaitTermination()
        return {r.order_id for r in store.snapshot().table("orders").collect()}

    assert run("events", "one") == {"north", "south", "west"}
    (tmp_path / "more").mkdir()
    more = event("east", "juri", "placed", "web", "2025-12-02T00:00:00Z", BACK)
    (tmp_path / "more" / "a.json").write_text(more + "\n{broken\n")
    assert run("more", "two") == {"north", "south", "west", "east"}
    refused = store.snapshot().table("refused_events").collect()
    assert [(r.errors, r.text) for r in refused] == [(["Body is not valid JSON"], "{broken")]
    later = event("east", "juri", "shipped", "web", "2025-12-02T00:00:00Z", BACK)
    (tmp_path / "more" / "a.json").unlink()
    (tmp_path / "more" / "b.json").write_text(later)
    run("more", "three")  # a new checkpoint starts at batch 0 again
    assert store.snapshot().table("orders").filter("order_id = 'east'").first().status == "shipped"
