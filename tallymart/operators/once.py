"""Columns that are computed exactly once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns that later filters and projections cannot duplicate.

    The optimizer moves a filter below the projection it reads and repeats the
    projected expression at every mention; parsing JSON thirty times per row is
    the price. A one-row generator computes the columns and stays in place.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
