"""Exports as compressed text: the same lines, a fraction of the bytes."""

import gzip
from datetime import date
from decimal import Decimal as D

from tallymart.plans import export as ex
from tallymart.plans.star import Star
from tallymart.plans.store import Store
from tallymart.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, EXPORTS, FACT_ORDER_ITEMS

DAY = date(2025, 11, 28)


def star_of(spark, lines=300):
    return Star(
        fact_order_items=spark.createDataFrame(
            [(str(i), 1, 1, 20251128, "placed", "web", 2, D("1.50"), D("3.00"), D("2.00"), D("1.00"), DAY)
             for i in range(lines)] * 2, FACT_ORDER_ITEMS),
        dim_date=spark.createDataFrame([(20251128, DAY, 2025, 4, 11, "November", 5, False)], DIM_DATE),
        dim_customer=spark.createDataFrame([(1, "c1", "Ann", "a@example.com", "FRANCE", DAY)], DIM_CUSTOMER),
        dim_product=spark.createDataFrame([(1, "p1", "Pen", "PROMO", D("1.00"), D("1.50"))], DIM_PRODUCT),
    )


def lines_of(folder, ending, read):
    return sorted(line for f in folder.glob(f"*{ending}") for line in read(f).decode().splitlines())


def test_compressed_lines_are_the_plain_ones(spark, tmp_path):
    star = star_of(spark)
    plain = ex.export(star, str(tmp_path / "out"), "plain")
    packed = ex.export(star, str(tmp_path / "out"), "packed", "gzip")
    assert plain == packed == {"dim_date": 1, "dim_customer": 1, "dim_product": 1, "fact_order_items": 600}
    for table in EXPORTS:
        a, b = tmp_path / f"out/run=plain/{table}", tmp_path / f"out/run=packed/{table}"
        assert lines_of(a, ".json", lambda f: f.read_bytes()) == lines_of(b, ".json.gz", lambda f: gzip.decompress(f.read_bytes()))
        assert not list(b.glob("*.json"))
    size = {run: sum(f.stat().st_size for f in (tmp_path / f"out/run={run}/fact_order_items").glob("*.json*"))
            for run in ("plain", "packed")}
    assert 5 * size["packed"] < size["plain"]


def test_compressed_export_is_loaded_whole(spark, tmp_path):
    star = star_of(spark)
    counts = ex.export(star, str(tmp_path / "out"), "run1", "gzip")
    store = Store(spark, str(tmp_path / "store"))
    store.init()
    loaded = ex.load(store, str(tmp_path / "out"), "run1", counts).table("loaded_fact_order_items")
    sent = ex.export_frames(star)["fact_order_items"]
    assert sorted(loaded.collect()) == sorted(sent.collect())
