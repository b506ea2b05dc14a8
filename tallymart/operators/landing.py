"""Landing zone: the newest document per order, and when the order was first seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.ranking import latest_per_key, latest_where_repeated, repeated_keys, same_key


def newest_of_batch(accepted: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per order of a batch (the highest position wins), stamped once."""
    sent = accepted.select("position", "order_id", "doc")
    last = latest_where_repeated(sent, ["order_id"], ["position"])
    return last.select(
        "order_id",
        "doc",
        ingested_at.alias("ingested_at"),
        ingested_at.alias("first_seen_at"),
        F.to_date(ingested_at).alias("ingested_date"),
    )


def land(current: DataFrame, batch: DataFrame) -> DataFrame:
    """`current` with the batch on top: new document and time, old first sight.

    `current` may be any subset of the landing table that holds every earlier
    version of the orders in the batch. Orders with one row only pass as they are.
    """
    columns = ["order_id", "doc", "ingested_at", "first_seen_at", "ingested_date"]
    # At one instant the batch, which arrived later, wins.
    rows = current.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)))
    again, held = repeated_keys(rows, ["order_id"], _first=F.min("first_seen_at"))
    if not held:
        return rows.select(*columns)
    same = same_key(["order_id"])
    several = latest_per_key(
        rows.join(again, same, "left_semi"), ["order_id"], ["ingested_at", "_batch"]
    ).join(again, same).withColumn("first_seen_at", F.col("_first"))
    return rows.join(again, same, "left_anti").select(*columns).unionByName(several.select(*columns))
