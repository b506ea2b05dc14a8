"""Tables that change together.

A run writes new Parquet folders and then publishes one small manifest that names
the folder of every table (and of every part, for tables laid out by date). Readers
resolve a manifest once, so all their tables come from one instant; a run that
fails before publishing changes nothing; a run that started from an older manifest
is refused. Parts that a run did not touch keep their old folder.

A part is a month by default. Use `grain="day"` where a month of data is more than
a run should rewrite, and `buckets` to cut the parts of orders and their lines further
by order, so that a correction of few orders reads and rewrites only their buckets.
Parts of tables that are looked up by key keep a filter of their keys in `filters/`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.key_filter import build_filters
from tallymart.operators.keyed import current_rejections
from tallymart.plans.star import Star
from tallymart.schemas import ARRIVALS, BUCKETED, BY_RUN, DAILY, FILTERED, TABLES

# Tables that follow from another one: name -> (that table, how)
VIEWS = {"rejected_records": ("rejection_log", current_rejections)}


class StaleSnapshot(RuntimeError):
    """Another run published first."""


@dataclass(frozen=True)
class Rewrite:
    """New content of a table; with `parts`, only of those parts.

    `cluster` sorts the rows of each file, so that readers can skip row groups.
    """

    rows: DataFrame
    parts: list[date | str] | None = None
    cluster: tuple[str, ...] = ()


def part_of(column: str, grain: str) -> Column:
    """The part a date belongs to."""
    return F.col(column) if grain == "day" else F.trunc(column, grain)


def partition(name: str) -> str:
    """The column that names the folders of a table: day tables use their own date, so
    that a filter on it prunes; the others a part derived from it."""
    return TABLES[name][1] if name in DAILY else "part"


def spread_by_range(rows: DataFrame, order: list[str], task_bytes: int = 32 << 20) -> DataFrame:
    """Rows in ranges of `order`, sorted inside, as many ranges as the plan's size asks for.

    The plan counts files as they are stored, and compressed text grows some tenfold.
    """
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, min(100_000, -(-int(str(size)) // task_bytes)))
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def packed(rows: DataFrame) -> DataFrameWriter:
    """Tables are written once and kept, and payloads are wide: bytes count more than seconds."""
    return rows.write.option("compression", "zstd")


@dataclass(frozen=True)
class Snapshot:
    spark: SparkSession
    base: str
    version: int
    tables: dict[str, dict]
    meta: dict = field(default_factory=dict)
    grain: str = "month"
    buckets: int = 1
    _frames: dict = field(default_factory=dict, repr=False, compare=False)

    def parts(self, name: str) -> dict[str, str]:
        """Part (text) -> folder; tables without parts use ''."""
        return self.tables.get(name, {}).get("parts", {})

    def part(self, name: str) -> Column:
        """The part a row of the table belongs to: its date, and with buckets a number behind it."""
        if name in BY_RUN:
            return F.col(TABLES[name][1]).cast("string")
        day = part_of(TABLES[name][1], "day" if name in DAILY else self.grain)
        if self.buckets == 1 or name not in BUCKETED:
            return day
        bucket = F.pmod(F.xxhash64(BUCKETED[name]), F.lit(self.buckets)).cast("string")
        return F.concat(day.cast("string"), F.lit("~"), F.lpad(bucket, 5, "0"))

    def __contains__(self, name: str) -> bool:
        return name in self.tables or name in VIEWS

    def table(self, name: str, parts: Collection[date | str] | None = None) -> DataFrame:
        """A table, or only some of its parts; other parts are not even listed."""
        if parts is None:
            if name not in self._frames:
                source, view = VIEWS.get(name, (name, None))
                rows = self._read(source, self.parts(source))
                self._frames[name] = view(rows) if view else rows
            return self._frames[name]
        wanted = {str(p) for p in parts}
        return self._read(name, {k: v for k, v in self.parts(name).items() if k in wanted})

    def _read(self, name: str, parts: dict[str, str]) -> DataFrame:
        schema = TABLES[name][0] if name in TABLES else None
        if schema is None:
            schema = T.StructType.fromJson(self.tables[name]["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        root = f"{self.base}/data/{name}"
        if name in DAILY and len(set(parts.values())) == 1 and parts == self.parts(name):
            # The days of one folder are found, and pruned by filters, as partitions.
            paths = [f"{root}/{folder}" for folder in set(parts.values())]
        else:
            paths = [
                f"{root}/{folder}" + (f"/{partition(name)}={value}" if value else "")
                for value, folder in sorted(parts.items())
            ]
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def filters(self, name: str) -> tuple[DataFrame | None, set[str]]:
        """The key filters of a table, and the parts that have none."""
        kept = set(self.tables.get(name, {}).get("filtered", []))
        live = self.parts(name)
        folders = sorted(kept & set(live.values()))
        bare = {part for part, folder in live.items() if folder not in kept}
        if not folders:
            return None, bare
        # A folder may hold filters of parts that were rewritten since.
        paths = [f"{self.base}/filters/{name}/{folder}" for folder in folders]
        folder = F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1)
        rows = self.spark.read.parquet(*paths).where(
            F.concat("part", F.lit("/"), folder).isin([f"{p}/{f}" for p, f in live.items()]))
        return rows, bare

    def star(self) -> Star:
        return Star(
            *[self.table(t) for t in ("fact_order_items", "dim_date", "dim_customer", "dim_product")],
            customer_segments=(
                self.table("customer_segments") if "customer_segments" in self else None
            ),
        )


class Store:
    def __init__(self, spark: SparkSession, base: str, grain: str = "month", buckets: int = 1):
        if not base:
            raise ValueError("a target path must be set")
        if grain not in ("day", "month", "year"):
            raise ValueError("grain is day, month or year")
        self.spark, self.base, self.grain, self.buckets = spark, base.rstrip("/"), grain, buckets
        jvm = spark._jvm
        self._fs_types = jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.base).getFileSystem(self._conf)

    def _path(self, text: str):
        return self._fs_types.Path(text)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(path)]

    def snapshot(self) -> Snapshot:
        published = [n for n in self._names(f"{self.base}/manifests") if n.endswith(".json")]
        if not published:
            return Snapshot(self.spark, self.base, 0, {}, {}, self.grain, self.buckets)
        newest = max(published)
        text = self.spark.read.text(f"{self.base}/manifests/{newest}", wholetext=True).first()[0]
        manifest = json.loads(text)
        grain, buckets = manifest["meta"]["grain"], manifest["meta"].get("buckets", 1)
        if (grain, buckets) != (self.grain, self.buckets):
            raise ValueError(f"these tables are laid out by {grain}, in buckets: {buckets}")
        return Snapshot(
            self.spark, self.base, manifest["version"], manifest["tables"], manifest["meta"], grain, buckets
        )

    def init(self) -> Snapshot:
        """Publishes all tables, empty, unless they exist."""
        current = self.snapshot()
        missing = [t for t in TABLES if t not in current]
        if not missing:
            return current
        return self._publish(current, {**{t: {"parts": {}} for t in missing}, **current.tables}, {})

    def publish(
        self, base: Snapshot, changes: dict[str, Rewrite], meta: dict | None = None
    ) -> Snapshot:
        """Writes the changes, then makes them visible at once."""
        tables = dict(base.tables)
        for name, change in changes.items():
            tables[name] = self._write(base, name, change)
        return self._publish(base, tables, meta or {})

    def _write(self, base: Snapshot, name: str, change: Rewrite) -> dict:
        schema, dated = TABLES.get(name, (None, None))
        rows = change.rows
        if schema is not None:
            rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema])
        folder = f"v={base.version + 1:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.base}/data/{name}/{folder}"
        entry = {"schema": json.loads(rows.schema.json())}
        if dated is None:
            packed(rows).parquet(path)
            return {**entry, "parts": {"": folder}}
        # One part may hold a third of all rows. The rebalance hint gathers the rows
        # of a part for few files, and AQE splits parts that are too big for a task.
        # Clustered tables are split by range over part and keys, so a big part is
        # spread by its keys.
        by = partition(name)
        parts = change.parts or []
        if name in ARRIVALS and len(parts) == 1 and parts[0] is not None:
            # All rows go to one folder: nothing is gathered and nothing sorted.
            packed(rows).parquet(f"{path}/{by}={parts[0]}")
        else:
            if by == "part":
                rows = rows.withColumn("part", base.part(name))
            if change.cluster:
                spread = spread_by_range(rows, [by, *change.cluster])
            else:
                spread = rows.hint("rebalance", by)
            packed(spread).partitionBy(by).parquet(path)
        written = [n.split("=", 1)[1] for n in self._names(path) if n.startswith(f"{by}=")]
        kept = {} if change.parts is None else dict(base.parts(name))
        for value in change.parts or []:
            kept.pop(str(value), None)
        parts = {**kept, **{value: folder for value in written}}
        if name not in FILTERED:
            return {**entry, "parts": parts}
        if written:
            fields = [f for f in rows.schema.fields if f.name != "part"]
            keys = self.spark.read.schema(T.StructType([*fields, T.StructField("part", T.StringType())]))
            build_filters(keys.parquet(path), FILTERED[name], F.col("part")).write.parquet(
                f"{self.base}/filters/{name}/{folder}")
        earlier = set(base.tables.get(name, {}).get("filtered", []))
        filtered = sorted((earlier | ({folder} if written else set())) & set(parts.values()))
        return {**entry, "parts": parts, "filtered": filtered}

    def _publish(self, base: Snapshot, tables: dict, meta: dict) -> Snapshot:
        version = base.version + 1
        merged = {**base.meta, **meta, "grain": self.grain, "buckets": self.buckets}
        text = json.dumps({"version": version, "tables": tables, "meta": merged})
        folder = f"{self.base}/manifests"
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}.draft")
        stream = self._files.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        target = self._path(f"{folder}/{version:08d}.json")
        context = self._fs_types.FileContext.getFileContext(target.toUri(), self._conf)
        no_overwrite = self.spark._jvm.java.lang.reflect.Array.newInstance(
            self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(draft, target, no_overwrite)
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise StaleSnapshot(f"version {version} is already published") from error
            raise
        return Snapshot(self.spark, self.base, version, tables, merged, self.grain, self.buckets)
