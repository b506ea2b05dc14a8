"""Order events, staged tables and check rows derived from the generic tables.

The events carry real faults taken from the data: fractional quantities where the
discount is 10 %, negative prices where the tax is 8 %, products listed twice,
orders without lines, ids outside the known sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.shape import MAX_ITEMS
from tallymart.session import cut_lineage
from tallymart.sources import bridge

NOW = "2001-01-01T00:00:00Z"
UNKNOWN_SEGMENT = "MACHINERY"
LARGEST_KNOWN_SIZE = 45


def known_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of every market segment but one."""
    people = bridge.table(spark, folder, "customer")
    return people.filter(F.col("c_mktsegment") != UNKNOWN_SEGMENT).select(
        F.col("c_custkey").cast("string").alias("customer_id")
    )


def known_products(spark: SparkSession, folder: str) -> DataFrame:
    parts = bridge.table(spark, folder, "part")
    return parts.filter(F.col("p_size") <= LARGEST_KNOWN_SIZE).select(
        F.col("p_partkey").cast("string").alias("product_id")
    )


def sent_quantity(line: Column) -> Column:
    faulty = line["l_discount"] == 0.1
    return F.when(faulty, line["l_quantity"] + 0.5).otherwise(line["l_quantity"])


def sent_price(line: Column) -> Column:
    price = bridge.unit_price(line)
    return F.when(line["l_tax"] == 0.08, -price).otherwise(price).cast("decimal(11,2)")


_LINE = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return bridge.table(spark, folder, "lineitem").select("l_orderkey", F.struct(*_LINE).alias("line"))


def _item(line: Column) -> Column:
    """What is sent of a line; made of its gathered fields, so that it need not travel."""
    return F.struct(
        line["l_partkey"].cast("string").alias("product_id"),
        sent_quantity(line).alias("quantity"),
        sent_price(line).alias("unit_price"),
    )


def _oversized(lines: DataFrame, most_items: int) -> DataFrame:
    return (
        lines.groupBy("l_orderkey")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > most_items)
        .select("l_orderkey")
    )


def oversized_orders(spark: SparkSession, folder: str, most_items: int = MAX_ITEMS) -> DataFrame:
    """Orders that the door refuses by their number of items alone: `position`, `errors`."""
    known = bridge.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    reason = f"items: Array must contain at most {MAX_ITEMS} element(s)"
    return _oversized(_lines(spark, folder), most_items).join(known, "l_orderkey", "left_semi").select(
        F.col("l_orderkey").alias("position"), F.array(F.lit(reason)).alias("errors")
    )


def order_events(spark: SparkSession, folder: str, most_items: int = MAX_ITEMS) -> DataFrame:
    """One JSON event per order: `position` (the order key) and the text `value`.

    Orders beyond the contract's number of items are no events: `oversized_orders`
    names them, and their lines are never gathered.
    """
    lines = _lines(spark, folder)
    oversized = cut_lineage(_oversized(lines, most_items))
    items = (
        lines.join(oversized, "l_orderkey", "left_anti")
        .groupBy("l_orderkey")
        .agg(F.transform(F.sort_array(F.collect_list("line")), _item).alias("items"))
    )
    headers = bridge.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
    ).join(oversized, "l_orderkey", "left_anti")
    event = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        bridge.order_status().alias("status"),
        bridge.order_channel().alias("channel"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ordered_at"),
        F.coalesce("items", F.array().cast(items.schema["items"].dataType)).alias("items"),
    )
    return headers.join(items, "l_orderkey", "left").select(
        F.col("l_orderkey").alias("position"), F.to_json(event).alias("value")
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as documents ingested at `ts`, keyed by user."""
    return bridge.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("order_id"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        "event_id",
        F.col("props").alias("doc"),
    )


def check_history(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a history of check results."""
    return bridge.table(spark, folder, "events").select(
        F.col("event_type").alias("check_name"),
        (F.col("value") < 50).alias("passed"),
        F.col("event_id").cast("string").alias("observed"),
        F.col("ts").cast("timestamp").alias("checked_at"),
    )
