"""The load and the whole run, in order. Every step can be repeated safely."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from tallymart.operators import landing as lz
from tallymart.operators.key_filter import parts_that_may_hold
from tallymart.operators.keyed import (
    newest_rejections,
    rejection_entries,
    replace_children,
    touched_parts,
    upsert,
)
from tallymart.operators.quality import CHECKS, gate, run_checks
from tallymart.operators.ranking import latest_per_key, latest_where_repeated
from tallymart.operators.shape import check_shape, route_shape
from tallymart.operators.validate import (
    order_lines,
    rejections,
    split,
    validate_customer,
    validate_order,
    validate_product,
)
from tallymart.plans.marts import MARTS
from tallymart.plans.store import Rewrite, Snapshot, Store
from tallymart.plans.warehouse import build_warehouse
from tallymart.session import cut_lineage, pin_session, releases_scratch, spread
from tallymart.sources.files import EPOCH, parts_since, read_events, read_reference, read_since

ORDERS_SOURCE = "raw_orders"


@dataclass(frozen=True)
class Config:
    base: str
    customers: str
    products: str
    now: datetime | None = None  # fixed for replays; the current time by default

    def run_time(self) -> datetime:
        return self.now or datetime.now(timezone.utc)


def _lit(moment: datetime) -> F.Column:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def _union(*lists: list[date]) -> list[date]:
    return sorted({part for parts in lists for part in parts})


def _parts_of(rows: DataFrame, part: F.Column) -> list[date]:
    """One value per part of the table the rows go to."""
    return [row[0] for row in rows.select(part.alias("_part")).distinct().collect()]


def parts_of_keys(snap: Snapshot, name: str, changed: DataFrame, keys: list[str]) -> list:
    """The parts of a table that hold a key of `changed`.

    Filters say which parts may; only of these the keys are read.
    """
    filters, bare = snap.filters(name)
    passed = set() if filters is None else parts_that_may_hold(filters, changed, keys)
    candidates = set(snap.parts(name)) if passed is None else passed | bare
    if not candidates:
        return []
    return touched_parts(snap.table(name, candidates), changed, keys, snap.part(name))


def _rejection_change(
    snap: Snapshot, batches: list[tuple[str, DataFrame, DataFrame]], now: datetime
) -> Rewrite:
    """A new part of the log of rejections; no earlier one is read.

    `batches`: (source, accepted record ids, newest rejections).
    """
    run = snap.version + 1
    entries = [rejection_entries(source, accepted, refused, _lit(now), run)
               for source, accepted, refused in batches]
    return Rewrite(reduce(DataFrame.unionByName, entries), [str(run)])


@releases_scratch
def compact_rejections(store: Store, runs: int = 32) -> int:
    """Once the log has that many parts, one part with the rejections that stand replaces
    them. Returns the parts that are left."""
    snap = store.snapshot()
    if len(snap.parts("rejection_log")) >= runs:
        standing = snap.table("rejected_records").withColumns(
            {"refused": F.lit(True), "run": F.lit(snap.version + 1).cast("long")})
        snap = store.publish(snap, {"rejection_log": Rewrite(standing)})
    return len(snap.parts("rejection_log"))


# ---------------------------------------------------------------- reference


@releases_scratch
def load_reference(store: Store, config: Config) -> dict[str, int]:
    """Customers and products from CSV; the last valid row of an id wins."""
    now, snap, spark = config.run_time(), store.snapshot(), store.spark
    changes: dict[str, Rewrite] = {}
    batches, counts = [], {"rejected": 0}
    for name, path, key, rule in (
        ("customers", config.customers, "customer_id", validate_customer),
        ("products", config.products, "product_id", validate_product),
    ):
        judged = cut_lineage(rule(read_reference(spark, path)))
        valid, rejected = split(judged)
        newest = cut_lineage(
            latest_per_key(valid, [key], ["_order"]).withColumn("loaded_at", _lit(now))
        )
        changes[name] = Rewrite(upsert(snap.table(name), newest, [key]))
        refused = newest_rejections(rejections(rejected, name, ["_order"]), ["_order"]).drop(
            "_order"
        )
        batches.append((name, newest.select(F.col(key).alias("record_id")), refused))
        counts[name] = newest.count()
        counts["rejected"] += rejected.count()
    changes["rejection_log"] = _rejection_change(snap, batches, now)
    store.publish(snap, changes)
    return counts


# ------------------------------------------------------------------- orders


@releases_scratch
def ingest(
    store: Store, events: DataFrame, ingested_at: datetime, meta: dict | None = None
) -> tuple[int, DataFrame]:
    """Shape check and landing of one batch; (accepted orders, refused events).

    Refused events go to `refused_events` together with the landing.
    """
    snap = store.snapshot()
    stamp = _lit(ingested_at)
    # Judged once. One table for both kinds: folders of their own would need a sort.
    routed = cut_lineage(route_shape(events), codec="zstd")
    kept = routed.filter("NOT right").select(
        F.col("position").cast("string").alias("position"), "errors", "text",
        stamp.alias("refused_at"), F.to_date(stamp).alias("refused_date"))
    accepted = routed.filter("right").select("position", "order_id", "doc")
    batch = lz.newest_of_batch(accepted, stamp)
    part = snap.part("landing")
    parts = _union(
        parts_of_keys(snap, "landing", batch, ["order_id"]), _parts_of(batch, part)
    )
    # The touched parts hold every earlier version of the batch's orders.
    rows = lz.land(snap.table("landing", parts), batch)
    changes = {"landing": Rewrite(rows, parts)} if parts else {}
    today = _parts_of(kept, snap.part("refused_events"))
    if today:
        earlier = snap.table("refused_events", today)
        changes["refused_events"] = Rewrite(earlier.unionByName(kept), today)
    store.publish(snap, changes, meta)
    return batch.count(), check_shape(events)[1]


def watermark(snap: Snapshot) -> datetime:
    found = snap.table("watermarks").filter(F.col("source") == ORDERS_SOURCE).first()
    return found["position"] if found else EPOCH


@releases_scratch
def load_orders(
    store: Store, config: Config, since: datetime | None = None
) -> dict[str, int]:
    """Validates what was ingested after the watermark and brings it into staging.

    Data, rejections and watermark are published together. `since` replays from
    an earlier position.
    """
    now, snap = config.run_time(), store.snapshot()
    position = since or watermark(snap)
    # Judging a document costs far more than moving it, and a few large files would
    # keep most cores idle: spread the documents evenly first.
    parts = parts_since(snap.parts("landing"), position)
    arrived = spread(read_since(snap.table("landing", parts), position).select("doc", "ingested_at"))
    judged = validate_order(
        arrived, snap.table("customers"), snap.table("products"), _lit(now), text="doc"
    ).drop("doc").withColumns(
        {
            "valid": F.size("reasons") == 0,
            "order_date": F.to_date("ordered_at"),
            "_tie": F.xxhash64("payload"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    # The one written copy of the batch: counted while it is written. Valid and refused orders
    # lie side by side, each with the columns that are read of its kind.
    staged = {c: F.when(F.col("valid"), F.col(c)) for c in
              ("order_id", "customer_id", "status", "channel", "ordered_at", "order_date", "lines")}
    judged = judged.withColumns({**staged, "payload": F.when(~F.col("valid"), F.col("payload"))})
    seen = Observation()
    routed = cut_lineage(
        judged.observe(
            seen,
            F.count(F.lit(1)).alias("read"),
            F.count_if("valid").alias("loaded"),
            F.max("ingested_at").alias("position"),
        ),
        codec="zstd",
    )
    totals = seen.get
    if not totals["read"]:
        return {"read": 0, "loaded": 0, "rejected": 0}
    valid, rejected = routed.filter("valid"), routed.filter("NOT valid")

    newest = latest_where_repeated(
        valid, ["order_id"], ["ingested_at", "_tie"], row="_row"
    ).withColumn("loaded_at", _lit(now))
    part = snap.part("orders")
    parts = _union(
        parts_of_keys(snap, "orders", valid, ["order_id"]), _parts_of(newest, part)
    )
    refused = newest_rejections(
        rejections(rejected, "orders", ["ingested_at", "_row"]), ["ingested_at"], row="_row"
    ).drop("ingested_at", "_row")
    accepted = valid.select("record_id")
    mark = store.spark.createDataFrame([Row(source=ORDERS_SOURCE)]).select(
        "source", F.lit(totals["position"]).alias("position"), _lit(now).alias("updated_at")
    )
    changes = {
        "rejection_log": _rejection_change(
            snap, [("orders", accepted, refused)], now
        ),
        "watermarks": Rewrite(upsert(snap.table("watermarks"), mark, ["source"])),
    }
    if parts:
        # An order and its lines share their date, hence their part.
        changes["orders"] = Rewrite(
            upsert(snap.table("orders", parts), newest, ["order_id"]), parts
        )
        changes["order_items"] = Rewrite(
            replace_children(
                snap.table("order_items", parts),
                newest,
                order_lines(newest, ["order_date"]),
                "order_id",
            ),
            parts,
        )
    store.publish(snap, changes)
    read, loaded = totals["read"], totals["loaded"]
    return {"read": read, "loaded": loaded, "rejected": read - loaded}


# ---------------------------------------------------------- checks and marts


@releases_scratch
def check_quality(store: Store, config: Config, checks=CHECKS) -> dict[str, int]:
    """Runs and stores all checks, then fails the run if one failed."""
    snap = store.snapshot()
    results = run_checks(snap.table, checks).withColumn("checked_at", _lit(config.run_time()))
    stored = cut_lineage(results)
    history = snap.table("quality_results")
    store.publish(snap, {"quality_results": Rewrite(history.unionByName(stored))})
    gate(stored.collect())  # one row per check
    return {"checks": len(checks)}


@releases_scratch
def refresh_marts(store: Store) -> dict[str, int]:
    snap = store.snapshot()
    star = snap.star()
    store.publish(snap, {name: Rewrite(mart(star)) for name, mart in MARTS.items()})
    return {"marts": len(MARTS)}


def run_all(store: Store, config: Config) -> dict[str, dict[str, int]]:
    """One whole run; marts stay as they were if a check fails."""
    pin_session(store.spark)
    store.init()
    return {
        "load_reference": load_reference(store, config),
        "load_orders": load_orders(store, config),
        "compact_rejections": {"parts": compact_rejections(store)},
        "build_warehouse": build_warehouse(store),
        "check_quality": check_quality(store, config),
        "refresh_marts": refresh_marts(store),
    }


def ingest_files(store: Store, path: str, ingested_at: datetime) -> tuple[int, DataFrame]:
    return ingest(store, read_events(store.spark, path), ingested_at)
