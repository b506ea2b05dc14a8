"""CSV whose fields may hold line breaks, read in as many tasks as its bytes ask for.

A line begins a record where the number of quotes before it, from the start of its file, is
even. Every byte split counts the quotes of its own lines; the parities of the splits before
it, one small row per split, say how it begins; so the lines of all splits are cut into
records at once, and only lines of records that span several are gathered.

That is right for files whose quotes stand where RFC 4180 lets them stand, and that is checked
for every record. With a stray quote, a carriage return or a record of more than `RECORD_BYTES`
`read_records` gives None, and the caller reads the files from their start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.session import cut_lineage

RECORD_BYTES = 64 << 20
# A whole quoted field, once doubled quotes are gone: nothing but a comma or an end beside it.
_QUOTED_FIELD = r'(?<![^,])"[^"]*"(?![^,])'


def is_split(spark: SparkSession, path: str) -> bool:
    """Whether some file is larger than a split; only sizes are read."""
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    sizes = spark.read.format("binaryFile").load(path).agg(F.max("length").alias("most"))
    return (sizes.first()["most"] or 0) > most


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, '"', ""))


def _wellformed(record: Column) -> Column:
    plain = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), _QUOTED_FIELD, "")
    return ~F.contains(plain, F.lit('"'))


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, block, row, first, value) per record, or None where quotes do not tell records
    apart. `row` orders the records of a file, `first` marks its header."""
    lines = cut_lineage(
        spark.read.option("lineSep", "\n").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"), (_quotes(F.col("value")) % 2).alias("odd"), "value")
    )
    per_block = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.min("row").alias("from"), F.bool_or(F.contains("value", F.lit("\r"))).alias("returns"))
    # One row per split from here: its parity, and whether its file is balanced.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = cut_lineage(per_block.select(
        "file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("before"),
        (F.sum("odd").over(whole) % 2 == 0).alias("balanced"), F.min("from").over(whole).alias("header"), "returns"))
    if not blocks.select(F.coalesce(F.bool_and(F.col("balanced") & ~F.col("returns")), F.lit(True))).first()[0]:
        return None
    so_far = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    begun = lines.join(blocks, ["file", "block"]).withColumn(
        "starts", (F.coalesce(F.sum("odd").over(so_far), F.lit(0)) + F.col("before")) % 2 == 0)
    cut = cut_lineage(begun.withColumn("record", F.max(F.when(F.col("starts"), F.col("row"))).over(up_to)))
    # Lines at the head of a split may go on with a record of an earlier one.
    last = cut.groupBy("file", "block").agg(F.max("record").alias("last"))
    carried = last.select("file", "block", F.max("last").over(earlier).alias("carried"))
    pieces = cut.filter(~F.col("starts") | (F.col("odd") == 1)).join(carried, ["file", "block"]).select(
        "file", F.coalesce("record", "carried").alias("record"), "block", "row", "header", "value")
    sizes = pieces.groupBy("file", "record").agg(F.sum(F.octet_length("value") + 1).alias("size"))
    if (sizes.agg(F.max("size")).first()[0] or 0) > RECORD_BYTES:
        return None
    spanning = pieces.groupBy("file", "record").agg(
        F.min_by("block", "row").alias("block"), F.min("header").alias("header"),
        F.array_sort(F.collect_list(F.struct("row", "value"))).alias("lines"))
    records = cut.filter(F.col("starts") & (F.col("odd") == 0)).select("file", "block", "record", "header", "value").unionByName(
        spanning.select("file", "block", "record", "header", F.array_join("lines.value", "\n").alias("value")))
    records = cut_lineage(records.select(
        "file", "block", F.col("record").alias("row"), (F.col("record") == F.col("header")).alias("first"), "value"))
    return records if records.filter(~_wellformed(F.col("value"))).isEmpty() else None


def parse_records(records: DataFrame, columns: list[str], options: dict[str, str]) -> DataFrame | None:
    """The records as text columns with `_order`, or None where a header is another one."""
    schema = ", ".join(f"`_{k}` string" for k in range(len(columns)))
    value = F.when(F.col("first"), F.ltrim("value", F.lit("﻿"))).otherwise(F.col("value"))
    parsed = records.filter("value <> ''").withColumn("row_", F.from_csv(value, F.lit(schema), options))
    names = F.array(*[F.col(f"row_._{k}") for k in range(len(columns))])
    expected = F.array(*[F.lit(c.lstrip("﻿")) for c in columns])
    if not parsed.filter(F.col("first") & ~names.eqNullSafe(expected)).isEmpty():
        return None
    return parsed.filter(~F.col("first")).select(
        *[F.col(f"row_._{k}").alias(c) for k, c in enumerate(columns)], F.struct("file", "block", "row").alias("_order"))
