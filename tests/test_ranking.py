"""The distributed forms equal the plain windows, also with heavy ties."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators.ranking import _sorted_slices, global_index, global_ntiles, global_rank, latest_per_key


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small range partitions stay apart, so the offsets are really used."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def tied(spark):
    """Half of all rows share one value, a tenth have none."""
    value = F.when(F.col("id") % 10 == 1, None).when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 23)
    return spark.range(5003).select(F.format_string("%05d", "id").alias("id"), value.alias("value"))


@pytest.mark.parametrize("rows", [0, 1, 3, 10, 5003])
def test_ntile(tied, rows):
    some = tied.filter(F.col("id") < f"{rows:05d}")
    order = [F.asc("value"), F.asc("id")]
    plain = some.withColumn("tile", F.ntile(4).over(Window.orderBy(*order)))
    spread = global_ntiles(some, 4, {"tile": ["value", "id"]})
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_rank(tied):
    plain = tied.withColumn("rank", F.rank().over(Window.orderBy(F.desc("value"))))
    spread = global_rank(tied, "value", "id")
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_more_than_one_slice(tied):
    slices = _sorted_slices(tied, [F.desc("value"), F.asc("id")])
    assert slices.select(F.shiftright("_place", 33)).distinct().count() > 1


def test_rank_has_no_window_over_all_rows(tied):
    plan = global_rank(tied, "value", "id")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    windows = [line for line in physical.splitlines() if "Window [" in line]
    assert windows and not any("rank(" in line for line in windows)
    for line in windows:  # offsets over one row per slice, or minima per slice and value
        assert "_rows" in line or "_slice" in line


def test_index(tied):
    order = [F.desc("value"), F.asc("id")]
    plain = tied.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)
    assert sorted(map(repr, global_index(tied, order, "n").collect())) == sorted(map(repr, plain.collect()))


def test_latest(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, n int, v string")
    assert sorted(map(tuple, latest_per_key(rows, ["k"], ["n"]).collect())) == [
        ("a", 3, "y"), ("b", 2, "z")]


def test_latest_rows_of_nulls_ties_and_texts(spark):
    rows = [(1, None, "a", 1), (1, 3, None, 2), (1, 3, "b", 3), (None, None, None, 4), (2, None, "x", 5), (2, None, "y", 6),
            (3, 7, "z", 7), (3, 7, "z", 7)]
    frame = spark.createDataFrame(rows, "k int, n int, t string, v int").repartition(3)
    got = {r.k: r.v for r in latest_per_key(frame, ["k"], ["n", "t"]).collect()}
    assert got == {1: 3, None: 4, 2: 6, 3: 7}
    assert latest_per_key(frame, ["k"], ["n", "t"]).count() == 4
    assert latest_per_key(frame.filter("k > 9"), ["k"], ["n"]).count() == 0


def test_latest_rows_move_once(spark):
    """Hash aggregates only, and no exchange of whole rows before the newest are known."""
    frame = spark.createDataFrame([(k % 5, k, "text" * 9) for k in range(50)], "k int, n long, wide string")
    plan = latest_per_key(frame, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    before = plan[plan.index("HashAggregate"):]
    assert "wide" not in before.split("Exchange", 1)[1]
