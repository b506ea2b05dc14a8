"""Staging to star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.operators.keyed import assign_keys, insert_missing, touched_parts
from tallymart.plans.star import calendar
from tallymart.plans.store import Rewrite, Snapshot, Store
from tallymart.session import cut_lineage, releases_scratch


def fact_rows(
    order_items: DataFrame, orders: DataFrame, dim_product: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Business keys become surrogate keys; money is computed once, here.

    Lines and orders of one order share their day, so joining on both columns
    lets Spark prune and match day by day. Products come first: what moves to meet
    them is narrow while the lines lack their orders' columns.
    """
    headers = orders.join(
        dim_customer.select("customer_id", "customer_key"), "customer_id"
    ).select("order_id", "order_date", "customer_key", "status", "channel", "ordered_at")
    goods = dim_product.select("product_id", "product_key", "unit_cost")
    quantity, price, cost = F.col("quantity"), F.col("unit_price"), F.col("unit_cost")
    return (
        order_items.join(goods, "product_id")
        .join(headers, ["order_id", "order_date"])
        .select(
            "order_id",
            "product_key",
            "customer_key",
            v.date_key(F.col("ordered_at")).alias("date_key"),
            "status",
            "channel",
            "quantity",
            "unit_price",
            v.line_revenue(quantity, price).alias("revenue"),
            v.line_cost(quantity, cost).alias("cost"),
            v.line_margin(quantity, price, cost).alias("margin"),
            "order_date",
        )
    )


def dim_date(orders: DataFrame, current: DataFrame) -> DataFrame:
    """The calendar never shrinks and old days never change."""
    return insert_missing(current, calendar(orders, "order_date"), ["date_key"])


def dim_customer(staging: DataFrame, current: DataFrame) -> DataFrame:
    return assign_keys(current, staging, "customer_id", "customer_key")


def dim_product(staging: DataFrame, current: DataFrame) -> DataFrame:
    return assign_keys(current, staging, "product_id", "product_key")


def _inputs(snap: Snapshot, part: str) -> list[str | None]:
    return [snap.parts(t).get(part) for t in ("orders", "order_items")]


def _stale_parts(snap: Snapshot, costs_changed: DataFrame | None) -> list[str]:
    """Parts whose fact no longer follows from the staged folders it was built from.

    A part is stale if its orders or lines were rewritten, if someone else wrote
    its fact, or if it holds a product whose cost changed.
    """
    built = snap.meta.get("fact_inputs", {})
    fact = snap.parts("fact_order_items")
    known = {*snap.parts("orders"), *snap.parts("order_items"), *fact}
    stale = {p for p in known if built.get(p) != [*_inputs(snap, p), fact.get(p)]}
    if costs_changed is None:
        return sorted(stale)
    held = touched_parts(
        snap.table("fact_order_items"), costs_changed, ["product_key"],
        snap.part("fact_order_items"),
    )
    return sorted(stale | {str(p) for p in held})


def _dimensions(snap: Snapshot, full: bool) -> dict[str, DataFrame]:
    """New content of the dimensions whose staging changed since the last build."""
    built = snap.meta.get("dimension_inputs", {})
    fresh = {}
    for name, source, build in (
        ("dim_customer", "customers", dim_customer),
        ("dim_product", "products", dim_product),
    ):
        if full or built.get(name) != [snap.parts(source), snap.parts(name)]:
            fresh[name] = cut_lineage(build(snap.table(source), snap.table(name)))
    return fresh


def _costs_changed(snap: Snapshot, products: DataFrame) -> DataFrame:
    old = snap.table("dim_product").select("product_key", F.col("unit_cost").alias("old"))
    return products.join(old, "product_key").filter(
        ~F.col("unit_cost").eqNullSafe(F.col("old"))
    )


@releases_scratch
def build_warehouse(store: Store, full: bool = False) -> dict[str, int]:
    """Brings the star in line with staging; rewrites only what changed.

    `full` rebuilds every part from scratch, with the same result.
    """
    snap = store.snapshot()
    fresh = _dimensions(snap, full)
    customers, products = (
        fresh.get(name, snap.table(name)) for name in ("dim_customer", "dim_product")
    )
    if full:
        stale = sorted({*snap.parts("orders"), *snap.parts("fact_order_items")})
    else:
        stale = _stale_parts(
            snap, _costs_changed(snap, products) if "dim_product" in fresh else None
        )
    changes = {name: Rewrite(rows) for name, rows in fresh.items()}
    if stale:
        lines, orders = (snap.table(t, stale) for t in ("order_items", "orders"))
        # The first and the last order lie in the parts of the first and the last date.
        days = sorted({p[:10] for p in snap.parts("orders")})
        ends = [p for p in snap.parts("orders") if p[:10] in (days[0], days[-1])]
        changes["dim_date"] = Rewrite(dim_date(snap.table("orders", ends), snap.table("dim_date")))
        changes["fact_order_items"] = Rewrite(
            fact_rows(lines, orders, products, customers),
            stale,
        )
    after = store.publish(snap, changes)
    fact = after.parts("fact_order_items")
    built = {
        "fact_inputs": {
            p: [*_inputs(after, p), fact.get(p)] for p in {*after.parts("orders"), *fact}
        },
        "dimension_inputs": {
            name: [after.parts(source), after.parts(name)]
            for name, source in (("dim_customer", "customers"), ("dim_product", "products"))
        },
    }
    after = store.publish(after, {}, built)
    return {"fact_rows": after.table("fact_order_items").count(), "parts_rebuilt": len(stale)}
