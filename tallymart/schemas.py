"""Every table, declared once: used for reading, writing and contract checks."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


TEXT, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DATE, MOMENT, FLAG = T.DateType(), T.TimestampType(), T.BooleanType()

CUSTOMER_FILE = _table(
    ("customer_id", TEXT), ("name", TEXT), ("email", TEXT), ("country", TEXT), ("signup_date", TEXT)
)
PRODUCT_FILE = _table(
    ("product_id", TEXT), ("name", TEXT), ("category", TEXT), ("unit_cost", TEXT), ("list_price", TEXT)
)

LANDING = _table(
    ("order_id", TEXT), ("doc", TEXT), ("ingested_at", MOMENT), ("first_seen_at", MOMENT),
    ("ingested_date", DATE),
)

WATERMARKS = _table(("source", TEXT), ("position", MOMENT), ("updated_at", MOMENT))
REJECTED_RECORDS = _table(
    ("source", TEXT), ("record_id", TEXT), ("reasons", T.ArrayType(TEXT)), ("payload", TEXT),
    ("rejected_at", MOMENT), ("rejected_date", DATE),
)
# Every run adds its entries; what stands is the newest entry of each record.
REJECTION_LOG = T.StructType([
    *REJECTED_RECORDS.fields, T.StructField("refused", FLAG, True), T.StructField("run", LONG, True)])
REFUSED_EVENTS = _table(
    ("position", TEXT), ("errors", T.ArrayType(TEXT)), ("text", TEXT), ("refused_at", MOMENT),
    ("refused_date", DATE),
)
QUALITY_RESULTS = _table(
    ("check_name", TEXT), ("passed", FLAG), ("observed", TEXT), ("checked_at", MOMENT)
)

CUSTOMERS = _table(
    ("customer_id", TEXT), ("name", TEXT), ("email", TEXT), ("country", TEXT),
    ("signup_date", DATE), ("loaded_at", MOMENT),
)
PRODUCTS = _table(
    ("product_id", TEXT), ("name", TEXT), ("category", TEXT), ("unit_cost", MONEY),
    ("list_price", MONEY), ("loaded_at", MOMENT),
)
# order_date is the UTC day of ordered_at; it lays the files out so that a load
# rewrites only the parts it touches.
ORDERS = _table(
    ("order_id", TEXT), ("customer_id", TEXT), ("status", TEXT), ("channel", TEXT),
    ("ordered_at", MOMENT), ("loaded_at", MOMENT), ("order_date", DATE),
)
ORDER_ITEMS = _table(
    ("order_id", TEXT), ("product_id", TEXT), ("quantity", INT), ("unit_price", MONEY),
    ("order_date", DATE),
)

DIM_DATE = _table(
    ("date_key", INT), ("full_date", DATE), ("year", INT), ("quarter", INT), ("month", INT),
    ("month_name", TEXT), ("day_of_week", INT), ("is_weekend", FLAG),
)
DIM_CUSTOMER = _table(
    ("customer_key", LONG), ("customer_id", TEXT), ("name", TEXT), ("email", TEXT),
    ("country", TEXT), ("signup_date", DATE),
)
DIM_PRODUCT = _table(
    ("product_key", LONG), ("product_id", TEXT), ("name", TEXT), ("category", TEXT),
    ("unit_cost", MONEY), ("list_price", MONEY),
)
FACT_ORDER_ITEMS = _table(
    ("order_id", TEXT), ("product_key", LONG), ("customer_key", LONG), ("date_key", INT),
    ("status", TEXT), ("channel", TEXT), ("quantity", INT), ("unit_price", MONEY),
    ("revenue", AMOUNT), ("cost", AMOUNT), ("margin", AMOUNT), ("order_date", DATE),
)

# name -> (schema, the date column that lays out the files, or None)
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "landing": (LANDING, "ingested_date"),
    "refused_events": (REFUSED_EVENTS, "refused_date"),
    "watermarks": (WATERMARKS, None),
    "rejection_log": (REJECTION_LOG, "run"),
    "quality_results": (QUALITY_RESULTS, None),
    "customers": (CUSTOMERS, None),
    "products": (PRODUCTS, None),
    "orders": (ORDERS, "order_date"),
    "order_items": (ORDER_ITEMS, "order_date"),
    "dim_date": (DIM_DATE, None),
    "dim_customer": (DIM_CUSTOMER, None),
    "dim_product": (DIM_PRODUCT, None),
    "fact_order_items": (FACT_ORDER_ITEMS, "order_date"),
}

# What leaves the warehouse: no e-mail, and the fact carries its calendar day.
EXPORTS: dict[str, T.StructType] = {
    "dim_date": DIM_DATE,
    "dim_customer": T.StructType([f for f in DIM_CUSTOMER if f.name != "email"]),
    "dim_product": DIM_PRODUCT,
    "fact_order_items": T.StructType(
        [*FACT_ORDER_ITEMS.fields[:4], FACT_ORDER_ITEMS["order_date"], *FACT_ORDER_ITEMS.fields[4:11]]
    ),
}
EXPORT_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "fact_order_items": ["order_id", "product_key"],
}
# The loaded copy: the fact by day, clustered by its two join keys.
TABLES.update({
    f"loaded_{name}": (schema, "order_date" if name == "fact_order_items" else None)
    for name, schema in EXPORTS.items()
})
LOADED_CLUSTER = {"fact_order_items": ("customer_key", "product_key")}
# Laid out by day, and by run.
DAILY = {"loaded_fact_order_items"}
BY_RUN = {"rejection_log"}
# What comes in at once lies on one day, or is one run, as a rule, however much it is.
ARRIVALS = {"landing", "refused_events", "rejection_log"}
# Parts of these tables can be cut further by a hash of the order.
BUCKETED = {"orders": "order_id", "order_items": "order_id", "fact_order_items": "order_id"}
# Each part of these tables keeps a filter of its keys.
FILTERED = {"landing": ["order_id"], "orders": ["order_id"]}

NEVER_NULL = {
    "customers": [f.name for f in CUSTOMERS],
    "products": [f.name for f in PRODUCTS],
    "orders": [f.name for f in ORDERS],
    "order_items": [f.name for f in ORDER_ITEMS],
    "dim_date": [f.name for f in DIM_DATE],
    "dim_customer": [f.name for f in DIM_CUSTOMER],
    "dim_product": [f.name for f in DIM_PRODUCT],
    "fact_order_items": [f.name for f in FACT_ORDER_ITEMS],
    "watermarks": [f.name for f in WATERMARKS],
    "rejected_records": ["source", "record_id", "reasons", "payload", "rejected_at"],
    "quality_results": [f.name for f in QUALITY_RESULTS],
}
UNIQUE_KEYS = {
    "customers": [["customer_id"]],
    "products": [["product_id"]],
    "orders": [["order_id"]],
    "order_items": [["order_id", "product_id"]],
    "dim_date": [["date_key"], ["full_date"]],
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_product": [["product_key"], ["product_id"]],
    "fact_order_items": [["order_id", "product_key"]],
    "watermarks": [["source"]],
    "rejected_records": [["source", "record_id"]],
}
FOREIGN_KEYS = [
    ("order_items", "order_id", "orders"),
    ("fact_order_items", "product_key", "dim_product"),
    ("fact_order_items", "customer_key", "dim_customer"),
    ("fact_order_items", "date_key", "dim_date"),
]

# Columns the semantic model reads from the CSV snapshot.
SNAPSHOT_COLUMNS: dict[str, list[str]] = {
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "month_name", "year_month",
                 "day_of_week", "is_weekend"],
    "dim_customer": ["customer_key", "customer_id", "name", "country", "signup_date"],
    "dim_product": ["product_key", "product_id", "name", "category", "unit_cost", "list_price"],
    "fact_order_items": ["order_id", "product_key", "customer_key", "date_key", "status", "channel",
                         "quantity", "unit_price", "revenue", "cost", "margin"],
    "customer_segments": ["customer_id", "recency_score", "frequency_score", "monetary_score",
                          "segment"],
}
