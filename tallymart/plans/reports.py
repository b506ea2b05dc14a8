"""Reports over the marts, in the types and orders their readers expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators.ranking import latest_per_key


def _numbers(names: list[str], kind: str) -> list[F.Column]:
    return [F.col(name).cast(kind).alias(name) for name in names]


def report_monthly_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "year_month",
        *_numbers(["orders", "units"], "int"),
        *_numbers(["revenue", "margin", "margin_pct"], "double"),
    ).orderBy("year_month")


def report_top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= 100:
        raise ValueError("limit must be an integer between 1 and 100")
    best = products.orderBy("revenue_rank", "product_id").limit(limit)
    return best.select(
        F.col("revenue_rank").cast("int").alias("rank"),
        "product_id",
        "name",
        "category",
        *_numbers(["orders", "units"], "int"),
        *_numbers(["revenue", "margin"], "double"),
    )


def report_customer_segments(segments: DataFrame) -> DataFrame:
    total = F.sum("revenue")
    return (
        segments.groupBy("segment")
        .agg(
            F.count("*").cast("int").alias("customers"),
            F.round(F.avg("revenue"), 2).cast("double").alias("average_revenue"),
            total.alias("revenue"),
        )
        .orderBy(F.desc("revenue"))
        .withColumn("revenue", F.col("revenue").cast("double"))
    )


def rejections_by_source(rejected_records: DataFrame) -> DataFrame:
    return (
        rejected_records.groupBy("source")
        .agg(F.count("*").cast("int").alias("records"))
        .orderBy("source")
    )


def latest_check_results(quality_results: DataFrame) -> DataFrame:
    return latest_per_key(quality_results, ["check_name"], ["checked_at"]).orderBy("check_name")


def pipeline_status(
    watermarks: DataFrame, rejected_records: DataFrame, quality_results: DataFrame
) -> dict[str, DataFrame]:
    """How far orders are loaded, what is refused per source, the newest check results."""
    return {
        "orders_loaded_up_to": watermarks.agg(F.max("position").alias("position")),
        "rejected": rejections_by_source(rejected_records),
        "checks": latest_check_results(quality_results).select(
            "check_name", "passed", "observed", "checked_at"
        ),
    }


def status_rows(watermarks: DataFrame, rejected_records: DataFrame, quality_results: DataFrame) -> DataFrame:
    """The whole status as one answer: (part, name, passed, value)."""
    status = pipeline_status(watermarks, rejected_records, quality_results)
    no_verdict = F.lit(None).cast("boolean").alias("passed")
    position = F.date_format("position", "yyyy-MM-dd HH:mm:ss").alias("value")
    return (
        status["orders_loaded_up_to"].select(F.lit("orders_loaded_up_to").alias("part"), F.lit("orders").alias("name"), no_verdict, position)
        .unionByName(status["rejected"].select(
            F.lit("rejected").alias("part"), F.col("source").alias("name"), no_verdict, F.col("records").cast("string").alias("value")))
        .unionByName(status["checks"].select(
            F.lit("checks").alias("part"), F.col("check_name").alias("name"), "passed", F.col("observed").alias("value")))
    )
