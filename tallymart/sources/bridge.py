"""The retail star seen through generic order tables (lineitem, orders, part, ...).

Prices are cut to whole cents with `floor`, which every engine does alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.plans.star import Star, calendar

SHAPE_MAX_ITEMS = 200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unit_price(line: F.Column | None = None) -> F.Column:
    """Of a row of lineitem, or of a struct with its columns."""
    of = F.col if line is None else line.getField
    cents = F.floor(of("l_extendedprice") * 100 / of("l_quantity")).cast("decimal(10,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def unit_cost() -> F.Column:
    cents = F.floor(F.col("p_retailprice") * 60).cast("decimal(10,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def order_status() -> F.Column:
    digit = F.col("o_orderkey") % 10
    return (
        F.when(digit == 0, "cancelled")
        .when(digit == 1, "returned")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", "shipped")
        .otherwise("placed")
    )


def order_channel() -> F.Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "web")
        .when(priority == "3-MEDIUM", "mobile")
        .otherwise("store")
    )


def staged_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    # nation has one row per country: a fixed, small table.
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return customer.join(F.broadcast(nation), "c_nationkey").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        "country",
    )


def staged_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        unit_cost().alias("unit_cost"),
    )


def staged_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        order_status().alias("status"),
        order_channel().alias("channel"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
    )


def staged_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        unit_price().alias("unit_price"),
    )


def fact_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows; joins run on the integer keys of the source tables."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_key"),
        order_status().alias("status"),
        order_channel().alias("channel"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), unit_cost().alias("unit_cost")
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
        unit_price().alias("unit_price"),
    )
    quantity, price, cost = F.col("quantity"), F.col("unit_price"), F.col("unit_cost")
    return (
        lines.join(orders, "l_orderkey")
        .join(products, "l_partkey")
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").alias("product_key"),
            "customer_key",
            v.date_key(F.col("order_date")).alias("date_key"),
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


def star(spark: SparkSession, folder: str) -> Star:
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return Star(
        fact_order_items=fact_lines(spark, folder),
        # A generated calendar has no size statistics. It holds one short row per
        # day, some thousands for any real shop, so lines never move to meet it.
        dim_date=F.broadcast(calendar(days, "day")),
        dim_customer=staged_customers(spark, folder),
        dim_product=staged_products(spark, folder),
    )
