"""The four marts.

Each one aggregates the fact by surrogate key first and joins the dimension
afterwards, so the join sees one row per key and a hot product or customer
costs no more than a cold one. Counting orders per key first is exact because
an order has one customer, one channel and one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.operators.ranking import global_ntiles, global_rank
from tallymart.plans.star import Star


def _sales(star: Star) -> DataFrame:
    return star.fact_order_items.filter(v.is_sale(F.col("status")))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)


def monthly_revenue(star: Star) -> DataFrame:
    per_day = _sales(star).groupBy("date_key").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("margin").alias("margin"),
    )
    months = star.dim_date.select(
        "date_key", "year", "month", v.year_month(F.col("full_date")).alias("year_month")
    )
    return (
        per_day.join(months, "date_key")
        .groupBy("year", "month", "year_month")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "units")],
             *[F.sum(c).cast("decimal(22,2)").alias(c) for c in ("revenue", "margin")])
        .withColumn("margin_pct", percent(F.col("margin"), F.col("revenue")))
    )


def product_sales(star: Star) -> DataFrame:
    # The fact holds one line per product and order, but a plain count of lines
    # would be wrong for a source that repeats a product inside an order.
    per_product = _sales(star).groupBy("product_key").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("margin").alias("margin"),
    )
    names = star.dim_product.select("product_key", "product_id", "name", "category")
    return per_product.join(names, "product_key").select(
        "product_id", "name", "category", "orders", "units", "revenue", "margin"
    )


def product_performance(star: Star) -> DataFrame:
    return global_rank(product_sales(star), "revenue", "product_id", name="revenue_rank")


def customer_sales(star: Star) -> DataFrame:
    """Recency, frequency and monetary value of every customer with a sale."""
    days = star.dim_date.select("date_key", "full_date")
    per_customer = (
        _sales(star)
        .join(days, "date_key")
        .groupBy("customer_key")
        .agg(
            F.max("full_date").alias("last_order_date"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("revenue").alias("revenue"),
        )
    )
    names = star.dim_customer.select("customer_key", "customer_id", "name", "country")
    return per_customer.join(names, "customer_key").select(
        "customer_id", "name", "country", "last_order_date", "orders", "revenue"
    )


def segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    best_buyer = (frequency >= 3) & (monetary >= 3)
    return (
        F.when((recency == 4) & best_buyer, "champion")
        .when((recency >= 3) & (frequency >= 2), "loyal")
        .when(recency == 4, "new")
        .when((recency <= 2) & (monetary >= 3), "at risk")
        .otherwise("occasional")
    )


def customer_segments(star: Star) -> DataFrame:
    scored = global_ntiles(
        customer_sales(star),
        4,
        {
            score: [measure, "customer_id"]
            for score, measure in (
                ("recency_score", "last_order_date"),
                ("frequency_score", "orders"),
                ("monetary_score", "revenue"),
            )
        },
    )
    scores = [F.col(c) for c in ("recency_score", "frequency_score", "monetary_score")]
    return scored.withColumn("segment", segment(*scores))


def sales_by_country_channel(star: Star) -> DataFrame:
    per_customer = _sales(star).groupBy("customer_key", "channel").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("revenue").alias("revenue")
    )
    countries = star.dim_customer.select("customer_key", "country")
    return (
        per_customer.join(countries, "customer_key")
        .groupBy("country", "channel")
        .agg(F.sum("orders").alias("orders"),
             F.sum("revenue").cast("decimal(22,2)").alias("revenue"))
        .withColumn("average_order_value", F.round(F.col("revenue") / F.col("orders"), 2))
    )


MARTS = {
    "monthly_revenue": monthly_revenue,
    "product_performance": product_performance,
    "customer_segments": customer_segments,
    "sales_by_country_channel": sales_by_country_channel,
}
