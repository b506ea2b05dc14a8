"""Positions, ranks and tiles over a whole table without one big partition.

A window without PARTITION BY moves every row to one task. Here a global sort
spreads the rows over range partitions, each row learns its place inside its
partition, and a table with one row per partition supplies the offset. The
sorted rows are written once, so the places cannot change between the job
that counts them and the job that uses them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.session import cut_lineage

_PLACE = "_place"
_ROW = "_row"
_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def _sorted_slices(df: DataFrame, by: list[Column]) -> DataFrame:
    return cut_lineage(df.orderBy(*by).withColumn(_PLACE, F.monotonically_increasing_id()))


def _with_index(slices: DataFrame, index: str, total: str) -> DataFrame:
    """Turns (slice, place in slice) into a 0-based index; adds the row count."""
    slice_no = F.shiftright(_PLACE, _SLICE_BITS)
    counts = slices.groupBy(slice_no.alias("_slice")).agg(F.count("*").alias("_rows"))
    # One row per range partition, so these windows stay tiny at any scale.
    offsets = counts.select(
        "_slice",
        (F.sum("_rows").over(Window.orderBy("_slice")) - F.col("_rows")).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy()).alias(total),
    )
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    return (
        slices.withColumn("_slice", slice_no)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(index, F.col("_offset") + place)
        .drop("_offset", _PLACE)
    )


def global_index(df: DataFrame, by: list[Column], name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row in the order `by`, which must be total."""
    indexed = _with_index(_sorted_slices(df, by), name, "_total")
    return indexed.drop("_slice", "_total")


def _whole_division(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _tile(index: Column, rows: Column, tiles: int) -> Column:
    """Tile of a 0-based index: the first `rows mod tiles` tiles hold one row more."""
    size = _whole_division(rows, F.lit(tiles))
    extra = rows % tiles
    front = extra * (size + 1)
    return (
        F.when(index < front, _whole_division(index, size + 1) + 1)
        .otherwise(extra + _whole_division(index - front, F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def global_ntiles(df: DataFrame, tiles: int, orders: dict[str, list[Column]]) -> DataFrame:
    """Adds one tile column per entry of `orders` (name -> total order).

    Rows and values equal `ntile(tiles) over (order by ...)`. The rows are written
    once; the orders are sorted and numbered on their own columns and a row number
    only, and the tiles join on that number.
    """
    rows = cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()))
    out = rows
    for name, by in orders.items():
        keys = [key.alias(f"_by{i}") for i, key in enumerate(_plain(by))]
        narrow = rows.select(_ROW, *keys)
        sorted_ = _sorted_slices(narrow, [F.col(f"_by{i}") for i in range(len(by))])
        tile = _with_index(sorted_, "_index", "_total").select(
            F.col(_ROW), _tile(F.col("_index"), F.col("_total"), tiles).alias(name))
        out = out.join(tile, _ROW)
    return out.drop(_ROW)


def _plain(by: list[Column | str]) -> list[Column]:
    return [F.col(key) if isinstance(key, str) else key for key in by]


def global_rank(df: DataFrame, value: str, tie_breaker: str, name: str = "rank") -> DataFrame:
    """Adds `rank() over (order by value desc)`; `tie_breaker` only spreads equal values.

    A value (or null) shared by very many rows covers several range partitions. Its
    rank comes from a table with at most one row per partition; every other value
    lies inside one partition, where a window per value finds its first index.
    """
    slices = _sorted_slices(df, [F.desc(value), F.asc(tie_breaker)])
    indexed = _with_index(slices, "_index", "_total").drop("_total")
    leading = (
        indexed.groupBy("_slice")
        .agg(F.min_by(value, "_index").alias("_value"))
        .select("_value")
        .distinct()
    )
    spanning = (
        indexed.join(F.broadcast(leading), F.col(value).eqNullSafe(F.col("_value")))
        .groupBy("_value")
        .agg(F.min("_index").alias("_first_of_value"))
    )
    within = F.min("_index").over(Window.partitionBy("_slice", value))
    return (
        indexed.withColumn("_first_in_slice", within)
        .join(F.broadcast(spanning), F.col(value).eqNullSafe(F.col("_value")), "left")
        .withColumn(name, (F.coalesce("_first_of_value", "_first_in_slice") + 1).cast("int"))
        .select(*df.columns, name)
    )


def latest_per_key(
    df: DataFrame, keys: list[str], newest: list[str], row: str | None = None
) -> DataFrame:
    """One row per key: the one with the greatest `newest` columns, nulls being the least.

    Rows are numbered where they are written. The number of each key's newest row comes
    from hash aggregates over the key and the `newest` columns alone, which are combined
    before the shuffle, so a key with very many rows sends one row per task; whole rows
    move once, to meet the numbers that were chosen. `row` names a column that already
    numbers the rows of a written table; without it the rows are written here.
    """
    columns = df.columns
    if row is None:
        row = _ROW
        df = cut_lineage(df.withColumn(row, F.monotonically_increasing_id()))
    *earlier, last = newest
    if df.schema[last].dataType.typeName() in ("string", "binary", "struct", "array"):
        earlier, last = newest, row  # a hash aggregate cannot hold such values
    left = df.select(*dict.fromkeys([*keys, *newest, row]))
    for column in earlier:
        best = left.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(column).alias("_best"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        left = left.join(best, reduce(Column.__and__, same, F.col(column).eqNullSafe(F.col("_best"))), "left_semi")
    chosen = left.groupBy(*keys).agg(
        F.coalesce(F.max_by(row, last), F.max(row)).alias(row)).select(row)
    return df.join(chosen, row, "left_semi").select(*columns)


def same_key(keys: list[str]) -> Column:
    """Rows whose `keys` equal the columns of the same names behind a `_`, nulls included."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def repeated_keys(df: DataFrame, keys: list[str], **also: Column) -> tuple[DataFrame, int]:
    """(keys that more than one row has, number of these rows). The keys carry a `_` in front.

    Only the keys are moved, and what `also` aggregates. The result is a written table, so
    its size decides how it is joined: few keys reach the rows without moving them.
    """
    counted = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.count("*").alias("_copies"), *[column.alias(name) for name, column in also.items()])
    repeated = cut_lineage(counted.filter("_copies > 1"))
    held = repeated.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    return repeated.drop("_copies"), held


def latest_where_repeated(
    df: DataFrame, keys: list[str], newest: list[str], row: str | None = None
) -> DataFrame:
    """The rows of `latest_per_key`, for a written table in which few keys repeat.

    A row alone with its key is the newest one and stays where it is; only the rows of
    repeated keys are compared. Where these are many, all rows are.
    """
    repeated, held = repeated_keys(df, keys)
    if not held:
        return df
    if held * 4 > df.count():
        return latest_per_key(df, keys, newest, row)
    several = latest_per_key(df.join(repeated, same_key(keys), "left_semi"), keys, newest, row)
    return df.join(repeated, same_key(keys), "left_anti").unionByName(cut_lineage(several))
