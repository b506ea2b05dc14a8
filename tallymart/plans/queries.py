"""Every operator as a named query over the generic tables: (spark, folder) -> DataFrame.

The library keeps decimals, dates and arrays; `flat` turns a result into plain
numbers and texts so that any engine can be compared with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import values as v
from tallymart.operators import keyed, quality, shape, validate
from tallymart.operators.landing import land, newest_of_batch
from tallymart.operators.ranking import global_index, global_ntiles, global_rank, latest_per_key
from tallymart.plans import export as ex
from tallymart.plans import marts, measures, reports
from tallymart.plans.pipeline import Config, ingest, ingest_files, load_orders, load_reference, run_all, watermark
from tallymart.plans.star import Star, calendar
from tallymart.plans.store import Store
from tallymart.schemas import TABLES
from tallymart.session import checkpoint_folder, cut_lineage, pin_session, spread
from tallymart.sources import bridge
from tallymart.sources import bridge_docs as docs
from tallymart.sources.files import read_reference, read_since
from tallymart.streaming.orders import stream_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def flat(frame: DataFrame) -> DataFrame:
    columns = []
    for f in frame.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column, "; ")
        columns.append(column.alias(f.name))
    return frame.select(*columns)


def query(run: Query) -> Query:
    """Registers a query under the name of its function."""

    def wrapped(spark: SparkSession, folder: str) -> DataFrame:
        return flat(run(pin_session(spark), folder))

    QUERIES[run.__name__] = wrapped
    return run


def _on_star(name: str, run: Callable[[Star], DataFrame]) -> None:
    def on_star(spark: SparkSession, folder: str) -> DataFrame:
        return run(bridge.star(spark, folder))

    on_star.__name__ = name
    query(on_star)


def _with_segments(star: Star) -> Star:
    return replace(star, customer_segments=marts.customer_segments(star))


# ---------------------------------------------------------- marts and reports

for _name, _mart in marts.MARTS.items():
    _on_star(_name, _mart)
_on_star("report_monthly_revenue", lambda s: reports.report_monthly_revenue(marts.monthly_revenue(s)))
_on_star("report_top_products", lambda s: reports.report_top_products(marts.product_performance(s)))
_on_star(
    "report_customer_segments",
    lambda s: reports.report_customer_segments(marts.customer_segments(s)),
)
_on_star("product_performance_distributed", marts.product_performance)
_on_star("customer_segments_distributed", marts.customer_segments)

# ------------------------------------------------------------------- measures

SNAKE = {
    "Margin %": "margin_pct",
    "Revenue MoM %": "revenue_mom_pct",
}


def snake(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed(
        {c: SNAKE.get(c, c.lower().replace(" ", "_")) for c in frame.columns}
    )


SALES = ["Revenue", "Margin", "Margin %", "Orders", "Average Order Value", "Units", "Return Rate"]


def _measures(name: str, names: Sequence[str], by: Sequence[str] = (), where=None,
              segments: bool = False) -> None:
    def run(star: Star) -> DataFrame:
        context = _with_segments(star) if segments else star
        return snake(measures.measure(context, names, by, where))

    _on_star(name, run)


_measures("measures_total", list(measures.NEEDS), segments=True)
_measures("measures_by_month", [*SALES, "Daily Revenue", "Daily Margin"], ["dim_date.year_month"])
_measures("measures_by_category", SALES, ["dim_product.category"])
_measures("measures_by_channel", [*SALES, "Daily Revenue"], ["fact_order_items.channel"])
_measures("measures_by_country", SALES, ["dim_customer.country"])
_measures("measures_by_weekday", [*SALES, "Daily Revenue"],
          ["dim_date.day_of_week", "dim_date.is_weekend"])
_measures("return_rate", ["Return Rate"], ["dim_product.category", "fact_order_items.channel"])
_measures(
    "revenue_mom", ["Revenue", "Revenue Previous Month", "Revenue MoM %"], ["dim_date.year_month"]
)
_measures(
    "revenue_previous_month_by_day", ["Revenue", "Revenue Previous Month"], ["dim_date.full_date"]
)
_measures("revenue_by_segment", ["Revenue", "Orders", "Customers"],
          ["customer_segments.segment"], segments=True)
_measures("customers_by_country", ["Customers"], ["dim_customer.country"], segments=True)
_measures(
    "measures_in_context",
    [*SALES, "Daily Revenue", "Customers"],
    ["dim_customer.country"],
    where={
        "customer_segments.segment": lambda c: c.isin("champion", "loyal"),
        "dim_product.category": lambda c: c == "PROMO",
        "fact_order_items.channel": lambda c: c.isin("web", "mobile"),
        "dim_date.year": lambda c: c >= 1998,
    },
    segments=True,
)
_measures("revenue_by_status_filter", ["Revenue", "Orders"], ["fact_order_items.channel"],
          where={"fact_order_items.status": lambda c: c == "returned"})
_on_star("daily_by_month", lambda s: snake(measures.PAGES["daily_by_month"](s)))
_on_star("cards", lambda s: snake(measures.measure(
    s, ["Revenue", "Margin %", "Orders", "Average Order Value"])))
_on_star("revenue_by_category", lambda s: snake(measures.PAGES["revenue_by_category"](s)))
_on_star("by_channel", lambda s: snake(measures.PAGES["by_channel"](s)))
_on_star("measures_product_table", lambda s: snake(measures.PAGES["product_table"](s)))
_on_star("revenue_by_country", lambda s: snake(measures.PAGES["revenue_by_country"](s)))
_on_star(
    "customers_by_segment",
    lambda s: snake(measures.PAGES["customers_by_segment"](_with_segments(s))),
)
_on_star(
    "slicer_values",
    lambda s: measures.PAGES["slicer_channel"](s).select(
        F.lit("channel").alias("slicer"), F.col("channel").alias("value")
    ).unionByName(
        measures.PAGES["slicer_country"](s).select(
            F.lit("country").alias("slicer"), F.col("country").alias("value")
        )
    ),
)

# ---------------------------------------------------------------- star tables

_on_star("dim_date", lambda s: s.dim_date)
_on_star("dim_customer", lambda s: s.dim_customer)
_on_star("dim_product", lambda s: s.dim_product)
_on_star("fact_order_items", lambda s: measures.semantic_fact(s.fact_order_items))


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with an order before 1996 hold keys 1..n; all others are new."""
    people = bridge.staged_customers(spark, folder).drop("customer_key")
    early = bridge.staged_orders(spark, folder).filter(F.col("ordered_at") < "1996-01-01")
    holders = people.join(early.select("customer_id").distinct(), "customer_id", "left_semi")
    current = global_index(holders, [F.asc("customer_id")], "_index").select(
        (F.col("_index") + 1).alias("customer_key"), "customer_id",
        F.upper("name").alias("name"), "country",
    )
    return keyed.assign_keys(cut_lineage(current), people, "customer_id", "customer_key")


@query
def calendar_extension(spark: SparkSession, folder: str) -> DataFrame:
    """The order calendar extended by ship dates; days already there stay as they are."""
    orders = bridge.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    ships = bridge.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    current = calendar(orders, "day").withColumn("month_name", F.upper("month_name"))
    return keyed.insert_missing(current, calendar(ships, "day"), ["date_key"])


@query
def vanished_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows whose line is gone once returned lines are taken out of staging."""
    star = bridge.star(spark, folder)
    kept = bridge.table(spark, folder, "lineitem").filter(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
    )
    gone = keyed.vanished_lines(star.fact_order_items, star.dim_product, kept)
    return gone.select("order_id", "product_id", "quantity", "revenue")


@query
def orphan_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped on a day the order calendar does not have, per day."""
    star = bridge.star(spark, folder)
    shipped = bridge.table(spark, folder, "lineitem").select(
        v.date_key(F.col("l_shipdate")).alias("date_key")
    )
    return quality.orphans(shipped, star.dim_date, "date_key").groupBy("date_key").agg(
        F.count("*").alias("lines")
    )


# --------------------------------------------------- ranking without one task


@query
def distributed_ntile(spark: SparkSession, folder: str) -> DataFrame:
    orders = bridge.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return global_ntiles(
        orders,
        4,
        {
            "price_tile": ["o_totalprice", "o_orderkey"],
            "date_tile": ["o_orderdate", "o_orderkey"],
        },
    ).select("o_orderkey", "price_tile", "date_tile")


@query
def distributed_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Products by their number of lines: many products share a value."""
    lines = bridge.table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("lines")
    )
    return global_rank(lines, "lines", "l_partkey", name="line_rank")


@query
def distributed_index(spark: SparkSession, folder: str) -> DataFrame:
    people = bridge.table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return global_index(people, [F.desc("c_acctbal"), F.asc("c_custkey")], "position")


# ------------------------------------------------------------ events, landing


@query
def shape_check(spark: SparkSession, folder: str) -> DataFrame:
    """Order events and the loose properties of user events, by shape verdict."""
    orders = docs.order_events(spark, folder).select("value")
    loose = bridge.table(spark, folder, "events").select(F.col("props").alias("value"))
    judged = shape.judge_shape(shape.parse_events(orders.unionByName(loose))).select("errors")
    judged = judged.unionByName(docs.oversized_orders(spark, folder).select("errors"))
    return judged.groupBy(F.array_join("errors", "; ").alias("errors")).agg(
        F.count("*").alias("events")
    )


@query
def landing_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each day land on the earlier ones: newest document, first sight."""
    events = docs.user_events(spark, folder)
    stamped = events.select("order_id", "doc", "ingested_at",
                            F.col("ingested_at").alias("first_seen_at"),
                            F.to_date("ingested_at").alias("ingested_date"))
    middle = F.lit("2024-01-16").cast("timestamp")
    empty = stamped.limit(0)
    current = land(empty, stamped.filter(F.col("ingested_at") < middle))
    return land(current, stamped.filter(F.col("ingested_at") >= middle)).select(
        "order_id", "doc", "ingested_at", "first_seen_at"
    )


@query
def landing_batch(spark: SparkSession, folder: str) -> DataFrame:
    """All user events as one batch with one ingestion time; the highest id wins."""
    batch = docs.user_events(spark, folder).withColumnRenamed("event_id", "position")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return newest_of_batch(batch, stamp).select("order_id", "doc", "ingested_at", "first_seen_at")


@query
def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = docs.user_events(spark, folder)
    fresh = read_since(events, datetime(2024, 1, 15, tzinfo=timezone.utc))
    return fresh.select("event_id", "order_id", "ingested_at")


@query
def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    """The new position after each event type was read from mid January on."""
    events = bridge.table(spark, folder, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("ingested_at")
    )
    fresh = read_since(events, datetime(2024, 1, 15, tzinfo=timezone.utc))
    return fresh.groupBy("event_type").agg(F.max("ingested_at").alias("position"),
                                           F.count("*").alias("read"))


# ----------------------------------------------------------------- validation


def _judged_orders(spark: SparkSession, folder: str) -> DataFrame:
    # Written: the rules read the events twice, and gathering their lines costs as much as that.
    return validate.validate_order(
        cut_lineage(spread(docs.order_events(spark, folder))),
        docs.known_customers(spark, folder),
        docs.known_products(spark, folder),
        docs.NOW,
        text="value",
    ).drop("value")


@query
def order_validation_split(spark: SparkSession, folder: str) -> DataFrame:
    judged = _judged_orders(spark, folder)
    return judged.select("order_id", (F.size("reasons") == 0).alias("valid"),
                         F.size("reasons").alias("reasons"))


@query
def order_rejections(spark: SparkSession, folder: str) -> DataFrame:
    """Every rejected order with the whole list of its reasons."""
    _, rejected = validate.split(_judged_orders(spark, folder))
    return validate.rejections(rejected, "orders").select("source", "record_id", "reasons")


@query
def order_rejection_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """How often each rule fires, without positions and ids."""
    _, rejected = validate.split(_judged_orders(spark, folder))
    reason = F.explode("reasons").alias("reason")
    rule = F.regexp_replace(
        F.regexp_replace("reason", r"^item \d+: ", ""), r"\d+", "N"
    ).alias("rule")
    return rejected.select(reason).groupBy(rule).agg(F.count("*").alias("times"))


@query
def accepted_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Only lines of wholly valid orders are staged."""
    valid, _ = validate.split(_judged_orders(spark, folder))
    return validate.order_lines(valid)


@query
def duplicate_items(spark: SparkSession, folder: str) -> DataFrame:
    """Products listed twice in an order, counted per pair."""
    items = bridge.staged_items(spark, folder)
    return items.groupBy("order_id", "product_id").agg(F.count("*").alias("copies")).filter(
        F.col("copies") > 1
    )


@query
def orders_without_items(spark: SparkSession, folder: str) -> DataFrame:
    orders = bridge.staged_orders(spark, folder)
    return orders.join(
        bridge.staged_items(spark, folder).select("order_id"), "order_id", "left_anti"
    ).select("order_id", "status", "ordered_at")


@query
def known_customer_check(spark: SparkSession, folder: str) -> DataFrame:
    """Customer ids that orders mention but the known set lacks."""
    return validate.unknown_ids(
        bridge.staged_orders(spark, folder), docs.known_customers(spark, folder), "customer_id"
    )


def _customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    people = bridge.table(spark, folder, "customer")
    mark = F.when(F.col("c_acctbal") < 0, "").otherwise("@")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return people.select(
        F.concat(F.lit("  C"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("customer_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "   ").otherwise(F.col("c_name")).alias("name"),
        F.concat(F.lit("User"), F.col("c_custkey").cast("string"), mark, F.lit("Example.COM"))
        .alias("email"),
        F.when(F.col("c_nationkey") > 0, F.col("c_nationkey").cast("string")).alias("country"),
        F.concat(F.lit("1996-"), two(F.col("c_nationkey") % 14), F.lit("-"),
                 two(F.col("c_custkey") % 33)).alias("signup_date"),
    )


@query
def customer_validation(spark: SparkSession, folder: str) -> DataFrame:
    judged = validate.validate_customer(_customer_rows(spark, folder))
    return judged.select("record_id", "name", "email", "signup_date", "reasons")


def _product_rows(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    cost = (
        F.when(size <= 40, price)
        .when(size <= 44, F.concat(F.lit("-"), price))
        .when(size <= 46, F.concat(price, F.lit("1")))
        .when(size == 47, F.concat(price, F.lit("0")))
        .when(size == 48, "abc")
        .when(size == 49, "")
        .otherwise(F.concat(price, F.lit("e1")))
    )
    return bridge.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("category"),
        cost.alias("unit_cost"),
        F.concat(F.lit(" "), price, F.lit(" ")).alias("list_price"),
    )


@query
def product_validation(spark: SparkSession, folder: str) -> DataFrame:
    judged = validate.validate_product(_product_rows(spark, folder))
    return judged.select("record_id", "unit_cost", "list_price", "reasons")


# --------------------------------------------------------------- keyed writes


@query
def upsert_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as first placed, then the newer state of those that moved on."""
    orders = bridge.staged_orders(spark, folder)
    moved = orders.filter(F.col("status") != "placed")
    return keyed.upsert(orders.withColumn("status", F.lit("placed")), moved, ["order_id"])


@query
def replace_children(spark: SparkSession, folder: str) -> DataFrame:
    """Web orders are sent again with repeated products merged into one line."""
    items = bridge.staged_items(spark, folder)
    resent = bridge.staged_orders(spark, folder).filter(F.col("channel") == "web")
    merged = items.join(resent.select("order_id"), "order_id", "left_semi").groupBy(
        "order_id", "product_id"
    ).agg(F.sum("quantity").cast("int").alias("quantity"), F.max("unit_price").alias("unit_price"))
    return keyed.replace_children(items, resent, merged, "order_id")


@query
def latest_check_result(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latest_check_results(docs.check_history(spark, folder))


@query
def last_row_wins(spark: SparkSession, folder: str) -> DataFrame:
    """The last order per customer by date and key."""
    orders = bridge.table(spark, folder, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("order_date"), "o_orderkey", "o_orderstatus"
    )
    return latest_per_key(orders, ["o_custkey"], ["order_date", "o_orderkey"])


@query
def rejections_after_correction(spark: SparkSession, folder: str) -> DataFrame:
    """Rejections of a first load, then a second load in which store orders are
    accepted and web orders are rejected for a new reason."""
    orders = bridge.staged_orders(spark, folder)
    first, second = (F.lit(f"2001-01-0{d}").cast("timestamp") for d in (1, 2))
    reason = F.array(F.concat(F.lit("unknown status "), F.col("status")))
    start = orders.select(
        F.lit("orders").alias("source"), F.col("order_id").alias("record_id"),
        reason.alias("reasons"), F.lit("{}").alias("payload"),
        first.alias("rejected_at"), F.to_date(first).alias("rejected_date"),
    ).filter(F.col("status").isin("cancelled", "returned"))
    accepted = orders.filter(F.col("channel") == "store").select(F.col("order_id").alias("record_id"))
    again = orders.filter((F.col("channel") == "web") & (F.col("status") != "placed")).select(
        F.lit("orders").alias("source"), F.col("order_id").alias("record_id"),
        F.array(F.lit("unknown channel web")).alias("reasons"), F.lit("{}").alias("payload"),
    )
    earlier = start.withColumns({"refused": F.lit(True), "run": F.lit(1).cast("long")})
    log = earlier.unionByName(keyed.rejection_entries("orders", accepted, again, second, 2))
    return keyed.current_rejections(log).select("source", "record_id", "reasons", "rejected_at")


# --------------------------------------------------------------------- checks


def _lookup(spark: SparkSession, folder: str) -> quality.Tables:
    star = bridge.star(spark, folder)
    tables = {
        "order_items": bridge.staged_items(spark, folder),
        "orders": bridge.staged_orders(spark, folder),
        **{t: getattr(star, t) for t in ex.EXPORTS},
    }
    return tables.__getitem__


@query
def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(_lookup(spark, folder))


@query
def constraint_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and references of the derived tables; repeated lines are real failures."""
    names = {
        "unique_orders_order_id", "unique_order_items_order_id_product_id",
        "unique_dim_date_date_key", "unique_dim_date_full_date",
        "unique_dim_customer_customer_key", "unique_dim_product_product_id",
        "unique_fact_order_items_order_id_product_key", "foreign_key_order_items_order_id",
        "foreign_key_fact_order_items_product_key", "foreign_key_fact_order_items_customer_key",
        "foreign_key_fact_order_items_date_key", "not_null_dim_date",
        "not_null_fact_order_items",
    }
    chosen = [c for c in quality.constraint_checks() if c.name in names]
    chosen.append(
        quality.not_null("order_items", ["order_id", "product_id", "quantity", "unit_price"])
    )
    return quality.run_checks(_lookup(spark, folder), chosen)


# ----------------------------------------------------------- files and stores


def scratch(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints, visible to every executor."""
    return f"{checkpoint_folder(spark)}/runs/{uuid.uuid4().hex}"


def _export_star(spark: SparkSession, folder: str) -> Star:
    """The derived star with the columns the declared export schemas need."""
    star = bridge.star(spark, folder)
    return replace(
        star,
        dim_customer=star.dim_customer.withColumn("signup_date", F.lit("1995-01-01").cast("date")),
        dim_product=star.dim_product.withColumn("list_price", F.col("unit_cost")),
    )


@query
def export_fact(spark: SparkSession, folder: str) -> DataFrame:
    return ex.export_frames(_export_star(spark, folder))["fact_order_items"]


@query
def export_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ex.export_counts(_export_star(spark, folder))


@query
def export_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Written as NDJSON, loaded into the clustered copy, counted, read back."""
    path = scratch(spark)
    counts = ex.export(_export_star(spark, folder), f"{path}/files", "run1", "gzip")
    store = Store(spark, f"{path}/loaded")
    store.init()
    after = ex.load(store, f"{path}/files", "run1", counts)
    return after.table("loaded_fact_order_items")


@query
def loaded_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days of 1995 are exported again with doubled revenue and replace the loaded ones;
    a filter on the day then reads its folders only."""
    path, star = scratch(spark), _export_star(spark, folder)
    ex.export(star, f"{path}/files", "run1", "gzip")
    ex.load_days(spark, f"{path}/files", "run1", f"{path}/fact")
    again = star.fact_order_items.filter(F.year("order_date") == 1995).withColumn(
        "revenue", (F.col("revenue") * 2).cast("decimal(12,2)"))
    ex.export(replace(star, fact_order_items=again), f"{path}/files", "run2", "gzip")
    loaded = ex.load_days(spark, f"{path}/files", "run2", f"{path}/fact")
    return loaded.filter(F.col("order_date").between(F.lit("1994-12-01").cast("date"), F.lit("1995-01-31").cast("date")))


@query
def export_reload_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly mart over a reloaded export equals the mart over the source."""
    path = scratch(spark)
    counts = ex.export(_export_star(spark, folder), f"{path}/files", "run1", "gzip")
    store = Store(spark, f"{path}/loaded")
    store.init()
    return marts.monthly_revenue(ex.loaded_star(ex.load(store, f"{path}/files", "run1", counts)))


@query
def snapshot_contract(spark: SparkSession, folder: str) -> DataFrame:
    """A written snapshot held against the columns its readers need: one column was left
    out, one table is not there."""
    path = scratch(spark)
    ex.export_csv(_with_segments(_export_star(spark, folder)), path)
    frames = ex.read_csv_snapshot(spark, path, [t for t in ex.SNAPSHOT_COLUMNS if t != "dim_product"])
    return ex.contract_report({**frames, "dim_date": frames["dim_date"].drop("is_weekend")})


@query
def missing_target(spark: SparkSession, folder: str) -> DataFrame:
    """An export without a target is refused before a row is written; what would have left."""
    star, refusals = _export_star(spark, folder), []
    for run in (ex.export, ex.export_csv):
        try:
            run(star, "")
        except ValueError as refused:
            refusals.append(str(refused))
    return ex.export_counts(star).withColumn("refused", F.lit("; ".join(refusals)))


@query
def csv_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV snapshot, read back: segment scores next to their customer."""
    path = scratch(spark)
    star = _with_segments(_export_star(spark, folder))
    ex.export_csv(star, path)
    scores = read_reference(spark, f"{path}/customer_segments")
    people = read_reference(spark, f"{path}/dim_customer")
    return scores.join(people.drop("_order"), "customer_id").select(
        "customer_id", "country", "segment",
        *[F.col(c).cast("bigint").alias(c)
          for c in ("recency_score", "frequency_score", "monetary_score")],
    )


@query
def order_value_rejections(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with unknown words, times that are none and items that are no objects."""
    key = F.col("o_orderkey")
    sent = bridge.table(spark, folder, "orders").select(F.to_json(F.struct(
        key.cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(key % 3 == 0, "lost").otherwise(" Placed ").alias("status"),
        F.when(key % 5 == 0, "").otherwise("WEB").alias("channel"),
        F.when(key % 7 == 0, "soon").when(key % 11 == 0, "2000-02-30T00:00:00Z")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ordered_at"),
        F.array(key % 2).alias("items"))).alias("value"))
    people = bridge.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"))
    judged = validate.validate_order(
        shape.parse_events(sent).drop("value"), people, docs.known_products(spark, folder), docs.NOW)
    return judged.select(
        F.filter("reasons", lambda r: r != "ordered_at is in the future").alias("reasons"),
        F.get_json_object("payload", "$.status").alias("sent_status"),
    ).groupBy("reasons", "sent_status").agg(F.count("*").alias("orders"))


@query
def refused_events(spark: SparkSession, folder: str) -> DataFrame:
    """Loose properties and broken texts at the door: kept with their reasons and texts."""
    loose = bridge.table(spark, folder, "events").select(
        F.col("event_id").alias("position"), F.col("props").alias("value"))
    broken = bridge.table(spark, folder, "orders").select(
        (-F.col("o_orderkey")).alias("position"), F.concat(F.lit("{"), F.col("o_orderkey")).alias("value"))
    store = Store(spark, f"{scratch(spark)}/door")
    store.init()
    ingest(store, shape.parse_events(loose.unionByName(broken)), datetime.fromisoformat(docs.NOW))
    return store.snapshot().table("refused_events").select(
        F.col("position").cast("bigint").alias("position"), "errors", "text")


_RUNS: dict[tuple[str, str], Store] = {}


def _write_sources(spark: SparkSession, folder: str, path: str) -> Config:
    people = bridge.staged_customers(spark, folder).join(
        docs.known_customers(spark, folder), "customer_id"
    )
    people.select(
        "customer_id", "name",
        F.concat(F.lit("c"), F.col("customer_id"), F.lit("@example.com")).alias("email"),
        "country", F.lit("1995-01-01").alias("signup_date"),
    ).write.option("header", True).csv(f"{path}/customers")
    goods = bridge.staged_products(spark, folder).join(
        docs.known_products(spark, folder), "product_id"
    )
    goods.select(
        "product_id", "name", "category", "unit_cost", F.col("unit_cost").alias("list_price")
    ).write.option("header", True).csv(f"{path}/products")
    # Compressed: as plain text the events outweigh all that a run makes of them.
    docs.order_events(spark, folder).select("value").write.option("compression", "gzip").text(f"{path}/events")
    return Config(
        f"{path}/base", f"{path}/customers", f"{path}/products",
        datetime.fromisoformat(docs.NOW),
    )


def whole_run(spark: SparkSession, folder: str) -> Store:
    """CSV and JSON files through the whole pipeline, once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _RUNS:
        path = scratch(spark)
        config = _write_sources(spark, folder, path)
        store = Store(spark, config.base)
        store.init()
        ingest_files(store, f"{path}/events", config.run_time())
        _RUNS[key] = store, run_all(store, config)
    return _RUNS[key][0]


@query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """What every step of a whole run counted."""
    whole_run(spark, folder)
    steps = _RUNS[spark.sparkContext.applicationId, folder][1]
    rows = [(step, name, n) for step, counts in steps.items() for name, n in counts.items()]
    return spark.createDataFrame(rows, "step string, counted string, n long")


@query
def initial_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A second set-up creates nothing and keeps what is there: rows per declared table."""
    store = whole_run(spark, folder)
    before = store.snapshot()
    after = store.init()
    if before.version != after.version:
        raise AssertionError("tables that exist were set up again")
    fresh = Store(spark, scratch(spark))
    empty = fresh.init()
    names = sorted({*TABLES, "rejected_records"} - {"rejection_log"})  # the log grows with every load, its view does not
    counts = [after.table(t).agg(F.count("*").alias("rows")).select(
        F.lit(t).alias("table_name"), F.lit(empty.table(t).isEmpty()).alias("begins_empty"), "rows") for t in names]
    return reduce(DataFrame.unionByName, counts)


@query
def pipeline_status(spark: SparkSession, folder: str) -> DataFrame:
    """How far orders are loaded, what is refused, and how the checks went, as one answer."""
    snap = whole_run(spark, folder).snapshot()
    return reports.status_rows(*[snap.table(t) for t in ("watermarks", "rejected_records", "quality_results")])


@query
def declared_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Every declared constraint of the tables of a whole run."""
    return quality.declared_constraints(whole_run(spark, folder).snapshot().table)


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Negative quantities and days outside the calendar stop a run: what the gate saw."""
    tables = _lookup(spark, folder)
    fact = tables("fact_order_items")
    damaged = fact.withColumns({
        "quantity": F.when(F.col("order_id").endswith("7"), -F.col("quantity")).otherwise(F.col("quantity")),
        "date_key": F.when(F.col("order_id").endswith("3"), F.lit(99991231)).otherwise(F.col("date_key")),
    })
    results = quality.run_checks(lambda t: damaged if t == "fact_order_items" else tables(t)).collect()
    try:
        quality.gate(results)
        stopped = {}
    except quality.FailedChecks as failed:
        stopped = failed.observed
    rows = [(r["check_name"], r["check_name"] in stopped, r["observed"]) for r in results]
    return spark.createDataFrame(rows, "check_name string, stops boolean, observed string")


@query
def pipeline_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return whole_run(spark, folder).snapshot().table("monthly_revenue")


@query
def pipeline_fact(spark: SparkSession, folder: str) -> DataFrame:
    snap = whole_run(spark, folder).snapshot()
    goods = snap.table("dim_product").select("product_key", "product_id")
    people = snap.table("dim_customer").select("customer_key", "customer_id")
    return (
        snap.table("fact_order_items")
        .join(goods, "product_key")
        .join(people, "customer_key")
        .select("order_id", "product_id", "customer_id", "date_key", "status", "channel",
                "quantity", "revenue", "cost", "margin")
    )


@query
def pipeline_segments(spark: SparkSession, folder: str) -> DataFrame:
    return whole_run(spark, folder).snapshot().table("customer_segments")


@query
def pipeline_quality(spark: SparkSession, folder: str) -> DataFrame:
    results = whole_run(spark, folder).snapshot().table("quality_results")
    return results.select("check_name", "passed", "observed")


@query
def rejections_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rejections_by_source(
        whole_run(spark, folder).snapshot().table("rejected_records")
    )


@query
def pipeline_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Loading the same documents again changes nothing."""
    store = whole_run(spark, folder)
    before = store.snapshot()
    load_orders(store, Config(store.base, "", "", datetime.fromisoformat(docs.NOW)))
    after = store.snapshot()
    if watermark(before) != watermark(after):
        raise AssertionError("a replay moved the watermark")
    return after.table("order_items").select("order_id", "product_id", "quantity", "unit_price")


@query
def stream_order_load(spark: SparkSession, folder: str) -> DataFrame:
    """The same events through the stream end in the same staged orders."""
    path = scratch(spark)
    config = _write_sources(spark, folder, path)
    store = Store(spark, config.base)
    store.init()
    load_reference(store, config)
    stream_orders(store, config, f"{path}/events", f"{path}/progress").awaitTermination()
    return store.snapshot().table("orders").select(
        "order_id", "customer_id", "status", "channel", "ordered_at"
    )
