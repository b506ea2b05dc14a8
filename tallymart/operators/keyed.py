"""Keyed changes as joins: overwrite, insert, replace children, assign keys.

Each function returns the new content of a table; nothing is written here.
`updates` must hold one row per key (see `latest_per_key`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.ranking import global_index, latest_where_repeated


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `updates` replace or join the rows of `target` with the same key."""
    untouched = target.join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(updates.select(*target.columns))


def insert_missing(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Only keys that are new are added; rows already there never change."""
    fresh = updates.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def replace_children(
    target: DataFrame, parents: DataFrame, children: DataFrame, parent_key: str
) -> DataFrame:
    """All children of the given parents give way to the new ones."""
    others = target.join(parents.select(parent_key), parent_key, "left_anti")
    return others.unionByName(children.select(*target.columns))


def assign_keys(dim: DataFrame, updates: DataFrame, business_key: str, key: str) -> DataFrame:
    """Latest attributes per business key; a surrogate key, once given, stays.

    New business keys are numbered from the highest key on, by a global index
    that needs no single partition.
    """
    attributes = [c for c in dim.columns if c != key]
    fresh = updates.join(dim.select(business_key), business_key, "left_anti")
    highest = dim.agg(F.coalesce(F.max(key), F.lit(0)))
    indexed = global_index(fresh.select(*attributes), [F.asc(business_key)], "_index")
    numbered = indexed.withColumn(key, highest.scalar() + F.col("_index") + 1)
    changed = updates.select(*attributes).join(dim.select(business_key, key), business_key)
    kept = dim.join(updates.select(business_key), business_key, "left_anti")
    return (
        kept.select(*dim.columns)
        .unionByName(changed.select(*dim.columns))
        .unionByName(numbered.select(*dim.columns))
    )


def newest_rejections(rejected: DataFrame, order: list[str], row: str | None = None) -> DataFrame:
    """One rejection per record: the last one of the batch."""
    return latest_where_repeated(rejected, ["source", "record_id"], order, row)


def rejection_entries(
    source: str, accepted: DataFrame, rejected: DataFrame, now: Column, run: int
) -> DataFrame:
    """What a run adds to the log of rejections: accepted ids, and new rejections.

    `accepted` holds `record_id`; `rejected` holds one row per (source, record_id).
    """
    cleared = accepted.select(F.lit(source).alias("source"), "record_id").distinct()
    refused = rejected.withColumn("refused", F.lit(True))
    both = cleared.withColumn("refused", F.lit(False)).unionByName(refused, allowMissingColumns=True)
    return both.withColumns(
        {"rejected_at": now, "rejected_date": F.to_date(now), "run": F.lit(run).cast("long")})


def current_rejections(log: DataFrame) -> DataFrame:
    """The rejections that stand: of each record the newest entry, if that is a refusal.

    Within a run a refusal counts more than an acceptance. Entries that no later run
    followed stand as they are.
    """
    newest = latest_where_repeated(log, ["source", "record_id"], ["run", "refused"])
    return newest.filter("refused").drop("refused", "run")


def touched_parts(
    current: DataFrame, changed_keys: DataFrame, keys: list[str], part: Column
) -> list:
    """The parts of `current` that hold any of the given keys.

    Only the key and date columns are read; the result has one value per part.
    """
    hit = current.select(*keys, part.alias("_part")).join(
        changed_keys.select(*keys), keys, "left_semi"
    )
    return [row[0] for row in hit.select("_part").distinct().collect()]


def vanished_lines(
    fact: DataFrame, dim_product: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Fact rows whose (order, product) is no longer staged."""
    named = fact.join(dim_product.select("product_key", "product_id"), "product_key")
    return named.join(
        order_items.select("order_id", "product_id"), ["order_id", "product_id"], "left_anti"
    )
