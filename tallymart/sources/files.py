"""Reading reference files and raw events."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.shape import parse_events
from tallymart.sources.split_csv import is_split, parse_records, read_records

OVERLAP_MINUTES = 5
OVERLAP = f"{OVERLAP_MINUTES} minutes"
EPOCH = datetime(1970, 1, 1)


def _input_order() -> Column:
    """Where a row stands in the input: file, block of the file, row in the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_reference(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; every column stays text. Adds `_order`, the input order.

    A field may hold line breaks. Files larger than a split are cut into records by the
    quotes before each line (see `split_csv`); files that quotes do not cut safely, and
    files of one split, are parsed from their start. Pass `multi_line=False` for files
    known to hold no line breaks: they are split as they are.
    """
    options = {"escape": '"', "encoding": "UTF-8"}
    reader = (
        spark.read.options(**options)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
    )
    rows = reader.csv(path).withColumn("_order", _input_order())
    if multi_line and is_split(spark, path):
        records = read_records(spark, path)
        if records is not None:
            parsed = parse_records(records, [c for c in rows.columns if c != "_order"], options)
            rows = rows if parsed is None else parsed
    first = rows.columns[0]
    if first.startswith("\ufeff"):
        rows = rows.withColumnRenamed(first, first.lstrip("\ufeff"))
    return rows


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One JSON order event per line: `position`, the text `value`, the variant `event`."""
    lines = spark.read.text(path).select("value", _input_order().alias("position"))
    return parse_events(lines)


def read_since(landing: DataFrame, position: datetime | None, overlap: str = OVERLAP) -> DataFrame:
    """Documents ingested after the watermark minus the overlap.

    Both conditions are pushed to the files; `parts_since` chooses the parts to read.
    """
    start = F.lit(position or EPOCH).cast("timestamp") - F.expr(f"interval {overlap}")
    fresh = landing.filter(F.col("ingested_at") > start)
    if "ingested_date" in landing.columns:
        fresh = fresh.filter(F.col("ingested_date") >= F.to_date(start))
    return fresh


def parts_since(
    parts: Collection[str], position: datetime | None, overlap_minutes: int = OVERLAP_MINUTES
) -> list[date]:
    """Parts (first days, as text) that can hold documents ingested after the watermark
    minus the overlap: the last one that begins before that moment, and all later ones."""
    if position and position.tzinfo:
        position = position.astimezone(timezone.utc).replace(tzinfo=None)
    start = ""
    if position and position > EPOCH:
        start = str((position - timedelta(minutes=overlap_minutes)).date())
    days = sorted(parts)
    first = max([d for d in days if d <= start], default=start)
    return [date.fromisoformat(d) for d in days if d >= first]
