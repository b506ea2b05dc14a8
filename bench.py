"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymart.plans.queries import QUERIES  # noqa: E402
from tallymart.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_revenue",
    "product_performance",
    "customer_segments",
    "sales_by_country_channel",
    "report_customer_segments",
    "measures_by_month",
    "measures_by_country",
    "measures_product_table",
    "revenue_mom",
    "fact_order_items",
    "quality_checks",
    "distributed_ntile",
    "distributed_rank",
    "customer_segments_distributed",
    "landing_latest",
    "upsert_orders",
    "replace_children",
    "order_rejections",
    "export_reload",
    "pipeline_monthly_revenue",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tallymart-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            # Small local files: split them, validation is bound by CPU, not bytes.
            "spark.sql.files.maxPartitionBytes": "4m",
            "spark.sql.files.openCostInBytes": "512k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the JVM, list the files
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
