"""Words and tables as every operator here reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")
