"""The resolved star schema and the generated calendar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v


@dataclass(frozen=True)
class Star:
    """One consistent set of star tables; every report takes one of these."""

    fact_order_items: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    customer_segments: DataFrame | None = None


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame of `full_date`."""
    day = F.col("full_date")
    iso_weekday = F.weekday(day) + 1
    return days.select(
        v.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        iso_weekday.alias("day_of_week"),
        iso_weekday.isin(6, 7).alias("is_weekend"),
    )


def calendar(orders: DataFrame, day_column: str) -> DataFrame:
    """Every day from the first to the last order, whether or not it has orders."""
    bounds = orders.agg(F.min(day_column).alias("first"), F.max(day_column).alias("last"))
    days = bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("full_date")
    )
    return describe_days(days)
