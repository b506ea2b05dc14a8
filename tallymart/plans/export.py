"""Copies of the star for others: NDJSON per run, a reloaded layout, CSV snapshot.

No export holds an e-mail address: columns are selected from declared schemas.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import values as v
from tallymart.operators.quality import FailedChecks
from tallymart.plans.star import Star
from tallymart.plans.store import Rewrite, Snapshot, Store, spread_by_range
from tallymart.sources.files import read_reference
from tallymart.schemas import EXPORT_KEYS, EXPORTS, LOADED_CLUSTER, SNAPSHOT_COLUMNS


def new_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def export_frames(star: Star) -> dict[str, DataFrame]:
    """The four tables as they leave: no e-mail, and the fact with its calendar day."""
    day = star.dim_date.select("date_key", F.col("full_date").alias("order_date"))
    fact = star.fact_order_items.drop("order_date").join(day, "date_key")
    frames = {**{t: getattr(star, t) for t in EXPORTS}, "fact_order_items": fact}
    return {name: frames[name].select(*EXPORTS[name].fieldNames()) for name in EXPORTS}


def as_json_values(frame: DataFrame) -> DataFrame:
    """Money as text, because a reader's float would round it; dates are ISO already."""
    return frame.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in frame.schema
        ]
    )


def _spread_by_key(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Files in key order: a range split (even for hot keys) and a sort per file."""
    return frame.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _table_path(path: str, run_id: str, table: str) -> str:
    return f"{path.rstrip('/')}/run={run_id}/{table}"


def count_rows(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType]) -> dict[str, int]:
    return {t: spark.read.schema(s).json(f"{path}/{t}").count() for t, s in schemas.items()}


def export(
    star: Star, path: str, run_id: str | None = None, compression: str = "none"
) -> dict[str, int]:
    """NDJSON under `run=<id>/<table>`; returns the rows of the source per table.

    With `compression` (gzip, ...) the same lines are written to compressed files, which
    readers open by their ending. Plain text takes some ten times their bytes.
    """
    if not path:
        raise ValueError("a target path must be set to export")
    run_id = run_id or new_run_id()
    counts = {}
    for table, frame in export_frames(star).items():
        # Counted while it is written, where no later stage can run a row twice.
        seen = Observation()
        # Turned into text behind the shuffle: money is shorter as a number.
        lines = as_json_values(_spread_by_key(frame, EXPORT_KEYS[table]))
        lines.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
            "ignoreNullFields", False
        ).json(_table_path(path, run_id, table), compression=compression)
        counts[table] = seen.get["rows"]
    return counts


def _required(frame: DataFrame) -> DataFrame:
    """Fails the job on a null: every exported column is required."""
    return frame.select(
        *[
            F.coalesce(
                F.col(f.name), F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)
            ).alias(f.name)
            for f in frame.schema
        ]
    )


def read_export(
    spark: SparkSession, path: str, run_id: str, schemas: Mapping[str, T.StructType] = EXPORTS
) -> dict[str, DataFrame]:
    """Exported files under their declared schema; one bad value fails the read."""
    return {
        table: _required(
            spark.read.schema(schema).option("mode", "FAILFAST").json(
                _table_path(path, run_id, table)
            )
        )
        for table, schema in schemas.items()
    }


def load(
    store: Store, path: str, run_id: str, expected: Mapping[str, int] | None = None
) -> Snapshot:
    """Replaces all loaded tables at once from one export run.

    The fact is laid out by day and clustered by its two join keys. With
    `expected`, row counts are compared after the load and a gap raises.
    """
    frames = read_export(store.spark, path, run_id)
    snap = store.snapshot()
    changes = {
        f"loaded_{table}": Rewrite(frame, cluster=LOADED_CLUSTER.get(table, ()))
        for table, frame in frames.items()
    }
    after = store.publish(snap, changes)
    if expected is not None:
        reconcile(expected, {t: after.table(f"loaded_{t}").count() for t in expected})
    return after


def load_days(spark: SparkSession, path: str, run_id: str, target: str) -> DataFrame:
    """Days of an exported fact replace the same days at `target`; all other days stay.

    The copy is laid out by day and clustered like the loaded fact. A task that fails or
    runs twice leaves nothing behind: Spark moves whole days in once all are written.
    """
    fact = read_export(spark, path, run_id, {"fact_order_items": EXPORTS["fact_order_items"]})["fact_order_items"]
    spread_by_range(fact, ["order_date", *LOADED_CLUSTER["fact_order_items"]]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("order_date").parquet(target)
    return loaded_days(spark, target)


def loaded_days(spark: SparkSession, target: str) -> DataFrame:
    schema = EXPORTS["fact_order_items"]
    return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())


def loaded_star(snap: Snapshot) -> Star:
    tables = {t: snap.table(f"loaded_{t}") for t in EXPORTS}
    return Star(**tables)


def reconcile(exported: Mapping[str, int], loaded: Mapping[str, int]) -> None:
    """Raises and names every table whose loaded rows differ from the exported ones."""
    gaps = {
        f"loaded_rows_{table}": f"exported {rows}, loaded {loaded.get(table, 0)}"
        for table, rows in exported.items()
        if rows != loaded.get(table, 0)
    }
    if gaps:
        raise FailedChecks(gaps)


def snapshot_frames(star: Star) -> dict[str, DataFrame]:
    """The five tables of the CSV snapshot."""
    frames = {
        **export_frames(star),
        "dim_date": star.dim_date.withColumn("year_month", v.year_month(F.col("full_date"))),
        "customer_segments": star.customer_segments,
    }
    return {name: frames[name].select(*columns) for name, columns in SNAPSHOT_COLUMNS.items()}


def export_csv(star: Star, path: str) -> None:
    if not path:
        raise ValueError("a target path must be set to export")
    for name, frame in snapshot_frames(star).items():
        keys = EXPORT_KEYS.get(name, ["customer_id"])
        _spread_by_key(frame, keys).write.mode("overwrite").option("header", True).csv(
            f"{path.rstrip('/')}/{name}"
        )


def read_csv_snapshot(spark: SparkSession, path: str, tables: Collection[str] = tuple(SNAPSHOT_COLUMNS)) -> dict[str, DataFrame]:
    """The tables of a written snapshot, as text."""
    return {t: read_reference(spark, f"{path.rstrip('/')}/{t}").drop("_order") for t in tables}


def contract_report(
    frames: Mapping[str, DataFrame], needed: Mapping[str, list[str]] = SNAPSHOT_COLUMNS
) -> DataFrame:
    """One row per table that a reader needs: its rows, and what is missing."""
    problems = check_contract(frames, needed)
    rows = []
    for table in needed:
        missing = "; ".join(p for p in problems if p.startswith(f"{table}:"))
        frame = frames.get(table)
        if frame is None:
            any_frame = next(iter(frames.values()))
            frame = any_frame.limit(0)
        rows.append(frame.agg(F.count("*").alias("rows")).select(
            F.lit(table).alias("table_name"), "rows", F.lit(missing).alias("missing")))
    return reduce(DataFrame.unionByName, rows)


def check_contract(
    frames: Mapping[str, DataFrame], needed: Mapping[str, list[str]] = SNAPSHOT_COLUMNS
) -> list[str]:
    """Columns a reader needs that a snapshot does not have."""
    problems = []
    for table, columns in needed.items():
        if table not in frames:
            problems.append(f"{table}: missing")
            continue
        problems += [f"{table}: column {c} is missing"
                     for c in sorted(set(columns) - set(frames[table].columns))]
    return problems


def export_counts(star: Star) -> DataFrame:
    """One row per exported table with its row count."""
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, frame in export_frames(star).items()
    ]
    return reduce(DataFrame.unionByName, counts)
