"""Business rules for customers, products and orders.

Every record keeps all the reasons it is refused for, in rule order. Nothing is
collected: membership in the reference tables is a join on the distinct ids, and
only ids that are *not* known travel back to the orders that mention them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.functions.values import trimmed
from tallymart.operators.once import with_columns_once
from tallymart.operators.shape import field, kind, usual_order
from tallymart.session import cut_lineage

NO_ID = "?"


def _reasons(*checks: Column) -> Column:
    return F.array_compact(F.array(*checks))


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


# ------------------------------------------------------------- reference rows


def _raw_payload(df: DataFrame) -> Column:
    """The row as it came, printable; columns added by the reader start with '_'."""
    raw = [c for c in df.columns if not c.startswith("_")]
    return F.to_json(F.struct(*[F.col(c) for c in raw]), {"ignoreNullFields": "false"})


def validate_customer(rows: DataFrame) -> DataFrame:
    """Adds typed columns, `payload`, `record_id` and `reasons` to raw customer rows."""
    keep = [c for c in rows.columns if c.startswith("_")]
    clean = rows.select(
        *keep,
        _raw_payload(rows).alias("payload"),
        *[v.text_or_empty(_column_or_null(rows, c)).alias(c)
          for c in ("customer_id", "name", "email", "country", "signup_date")],
    ).withColumns({"email": F.lower("email"), "_signup": v.iso_date(F.col("signup_date"))})
    reasons = _reasons(
        v.required(F.col("customer_id"), "customer_id"),
        v.required(F.col("name"), "name"),
        v.email_reason(F.col("email")),
        v.required(F.col("country"), "country"),
        F.when(F.col("_signup").isNull(), F.lit("signup_date must be YYYY-MM-DD")),
    )
    return clean.withColumns(
        {"reasons": reasons, "signup_date": F.col("_signup"), "record_id": _record_id("customer_id")}
    ).drop("_signup")


def validate_product(rows: DataFrame) -> DataFrame:
    """Adds typed columns, `payload`, `record_id` and `reasons` to raw product rows."""
    keep = [c for c in rows.columns if c.startswith("_")]
    amounts = ("unit_cost", "list_price")
    clean = rows.select(
        *keep,
        _raw_payload(rows).alias("payload"),
        *[v.text_or_empty(_column_or_null(rows, c)).alias(c)
          for c in ("product_id", "name", "category")],
        *[v.money(v.text_or_empty(_column_or_null(rows, c))).alias(c) for c in amounts],
        *[v.too_large(v.text_or_empty(_column_or_null(rows, c))).alias(f"_large_{c}") for c in amounts],
    )
    reasons = _reasons(
        *[v.required(F.col(c), c) for c in ("product_id", "name", "category")],
        *[F.when(F.col(f"_large_{c}"), F.lit(f"{c} must be below {v.AMOUNT_LIMIT}"))
          .when(F.col(c).isNull(), F.lit(f"{c} must be a non-negative amount")) for c in amounts],
    )
    return clean.withColumns({"reasons": reasons, "record_id": _record_id("product_id")}).drop(
        *[f"_large_{c}" for c in amounts])


def _record_id(key: str) -> Column:
    return F.when(F.col(key) == "", F.lit(NO_ID)).otherwise(F.col(key))


# --------------------------------------------------------------------- orders


def _text_of(owner: Column, name: str) -> Column:
    """Trimmed text of a field; anything that is not text counts as empty."""
    value = field(owner, name)
    return F.when(F.schema_of_variant(value) == "STRING",
                  v.text_or_empty(F.try_variant_get(value, "$", "string"))).otherwise("")


def _item_fields(item: Column, position: Column) -> Column:
    """The fields of an item that are read, each found once."""
    return F.struct(
        (position + 1).alias("position"),
        item.alias("item"),
        *[field(item, name).alias(name) for name in ("product_id", "quantity", "unit_price")],
    )


def _raw_item(item: Column) -> Column:
    """What an item says, untyped. What holds a quantity or a price is an object, so the
    shape of the whole item is asked for only where both are missing."""
    product, quantity, price = item["product_id"], item["quantity"], item["unit_price"]
    return F.struct(
        item["position"].alias("position"),
        F.when(quantity.isNotNull() | price.isNotNull(), F.lit(True)).otherwise(kind(item["item"]) == "OBJECT")
        .alias("is_object"),
        F.when(F.schema_of_variant(product) == "STRING", v.text_or_empty(F.try_variant_get(product, "$", "string")))
        .otherwise("").alias("product_id"),
        F.schema_of_variant(quantity).alias("quantity_kind"),
        trimmed(F.try_variant_get(quantity, "$", "string")).alias("quantity"),
        F.schema_of_variant(price).alias("price_kind"),
        trimmed(F.try_variant_get(price, "$", "string")).alias("price"),
    )


def _with(item: Column, names: list[str], **more: Column) -> Column:
    return F.struct(*[item[n].alias(n) for n in names], *[c.alias(n) for n, c in more.items()])


_RAW = ["position", "is_object", "product_id", "quantity_kind", "quantity", "price_kind", "price"]


def _plain_item(raw: Column) -> Column:
    """Nearly all quantities and prices are plain amounts, which one pattern settles."""
    return _with(raw, _RAW, plain_quantity=v.plain_amount(raw["quantity"]), plain_price=v.plain_amount(raw["price"]))


def _split_item(item: Column) -> Column:
    """All other numbers are split once; every rule below reads the parts."""
    return _with(
        item, [*_RAW, "plain_quantity", "plain_price"],
        quantity_parts=F.when(item["plain_quantity"].isNull(), v.number_parts(item["quantity"])),
        price_parts=F.when(item["plain_price"].isNull(), v.number_parts(item["price"])),
    )


def _typed_item(item: Column) -> Column:
    """Amounts and whole quantities; null where the value is refused.

    A quantity must be a JSON number without a fraction; text is refused.
    """
    numeric = item["quantity_kind"].isin("BIGINT", "DOUBLE", "FLOAT") | item["quantity_kind"].startswith("DECIMAL")
    priced = ~item["price_kind"].isin("BOOLEAN", "VOID")
    price = item["plain_price"], item["price_parts"]
    return F.struct(
        item["position"].alias("position"),
        item["is_object"].alias("is_object"),
        F.when(item["is_object"], item["product_id"]).alias("product_id"),
        F.when(numeric, v.whole_number_of(item["plain_quantity"], item["quantity_parts"])).alias("quantity"),
        F.when(priced, v.money_of(*price)).alias("unit_price"),
        (priced & v.too_large_of(*price)).alias("too_dear"),
    )


def _usual_line(item: Column, position: Column) -> Column:
    """The same as `_typed_item` for a line whose numbers are short decimals."""
    quantity, price = item["quantity"], item["unit_price"]
    return F.struct(
        (position + 1).alias("position"),
        F.lit(True).alias("is_object"),
        v.text_or_empty(item["product_id"]).alias("product_id"),
        v.whole_number_exact(quantity).alias("quantity"),
        v.money_exact(price).alias("unit_price"),
        v.too_large_exact(price).alias("too_dear"),
    )


def read_orders(docs: DataFrame, event: str = "event") -> DataFrame:
    """Normalises order documents (a variant column) into flat header columns and `lines`.

    Usual orders are read in one go; any other field by field, with the same result.
    """
    doc, usual = F.col(event), F.col("_usual")
    items = F.try_variant_get(doc, "$.items", "array<variant>")

    def text(name: str) -> Column:
        return F.when(usual.isNotNull(), v.text_or_empty(usual[name])).otherwise(_text_of(doc, name))

    # Each step is an array of its own, so nothing is computed twice.
    lines = reduce(F.transform, [_item_fields, _raw_item, _plain_item, _split_item, _typed_item], items)
    return with_columns_once(
        with_columns_once(docs, {"_usual": usual_order(doc, typed=True)}),
        {
            "order_id": text("order_id"),
            "customer_id": text("customer_id"),
            "status": F.lower(text("status")),
            "channel": F.lower(text("channel")),
            "_ordered_at": text("ordered_at"),
            "lines": F.when(usual.isNotNull(), F.transform(usual["items"], _usual_line)).otherwise(lines),
        }
        # Not among these, so that it is left out where nobody reads it.
    ).withColumns({"payload": F.to_json(doc), "ordered_at": v.moment(F.col("_ordered_at"))}).drop(
        "_ordered_at", "_usual")


def _mentions(docs: DataFrame, event: str) -> DataFrame:
    """Only what the lookups need of a document: its digest and the ids it mentions."""
    doc = F.col(event)
    items = F.try_variant_get(doc, "$.items", "array<variant>")
    return docs.select(
        "doc_id",
        _text_of(doc, "customer_id").alias("customer_id"),
        F.array_distinct(F.transform(F.filter(
            F.transform(items, _item_fields),
            lambda item: item["quantity"].isNotNull() | item["unit_price"].isNotNull() | (kind(item["item"]) == "OBJECT")),
            lambda item: F.when(F.schema_of_variant(item["product_id"]) == "STRING", v.text_or_empty(
                F.try_variant_get(item["product_id"], "$", "string"))).otherwise(""))).alias("product_ids"),
    )


def unknown_ids(mentioned: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct ids that are mentioned but not known. Deduplicating first means a
    hot id crosses the network once per task."""
    return mentioned.select(key).distinct().join(known.select(key), key, "left_anti")


def _mark_unknown(
    docs: DataFrame, mentions: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Adds `customer_unknown` and `unknown_products` (array) to documents.

    The lookups are written tables, so their size in bytes decides how they are joined.
    Both answers travel to a document at once, before it is read: where it has to move to
    meet them, it moves as the text that came.
    """
    strangers = cut_lineage(unknown_ids(mentions, customers, "customer_id"))
    named = mentions.select("doc_id", F.explode("product_ids").alias("product_id")).filter(
        F.col("product_id").isNotNull()
    )
    missing = cut_lineage(unknown_ids(named, products, "product_id"))
    nobody = mentions.join(strangers, "customer_id").select(
        "doc_id", F.lit(True).alias("customer_unknown"))
    answers = cut_lineage(
        named.join(missing, "product_id").select("doc_id", "product_id")
        .unionByName(nobody, allowMissingColumns=True)
        .groupBy("doc_id")
        .agg(F.max("customer_unknown").alias("customer_unknown"),
             F.collect_set("product_id").alias("unknown_products")),
        codec="zstd",
    )
    return docs.join(answers, "doc_id", "left").withColumns(
        {
            "customer_unknown": F.coalesce("customer_unknown", F.lit(False)),
            "unknown_products": F.coalesce(
                "unknown_products", F.array().cast("array<string>")
            ),
        }
    )


def _line_reasons(line: Column, ids: Column, unknown: Column) -> Column:
    product, position = line["product_id"], line["position"]
    prefix = F.concat(F.lit("item "), position.cast("string"), F.lit(": "))
    repeated = F.array_position(ids, product) < position
    found = _reasons(
        F.when(
            F.array_contains(unknown, product),
            F.concat(prefix, F.lit("unknown product "), v.or_marker(product)),
        ).when(repeated, F.concat(prefix, F.lit("product "), product, F.lit(" listed twice"))),
        F.when(
            line["quantity"].isNull(),
            F.concat(prefix, F.lit("quantity must be a positive integer")),
        ),
        F.when(
            line["too_dear"], F.concat(prefix, F.lit(f"unit_price must be below {v.AMOUNT_LIMIT}"))
        ).when(
            line["unit_price"].isNull(),
            F.concat(prefix, F.lit("unit_price must be a non-negative amount")),
        ),
    )
    return F.when(line["is_object"], found).otherwise(
        F.array(F.concat(prefix, F.lit("not an object")))
    )


def order_reasons(now) -> Column:
    """All reasons of a marked order: header rules first, then its lines in order."""
    lines, unknown = F.col("lines"), F.col("unknown_products")
    header = _reasons(
        v.required(F.col("order_id"), "order_id"),
        F.when(
            F.col("customer_unknown"),
            F.concat(F.lit("unknown customer "), v.or_marker(F.col("customer_id"))),
        ),
        v.known_word_reason(F.col("status"), v.ORDER_STATUSES, "status"),
        v.known_word_reason(F.col("channel"), v.ORDER_CHANNELS, "channel"),
        F.when(F.col("ordered_at").isNull(), F.lit("ordered_at is not a valid timestamp")).when(
            F.col("ordered_at") > F.lit(now).cast("timestamp"),
            F.lit("ordered_at is in the future"),
        ),
        F.when(
            F.coalesce(F.size(lines), F.lit(0)) <= 0, F.lit("an order needs at least one item")
        ),
    )
    per_line = F.flatten(
        F.transform(lines, lambda line: _line_reasons(line, F.col("_ids"), unknown))
    )
    return F.concat(header, F.coalesce(per_line, F.array().cast("array<string>")))


def validate_order(
    docs: DataFrame, customers: DataFrame, products: DataFrame, now, event: str = "event", text: str | None = None
) -> DataFrame:
    """Adds header columns, `lines`, `payload`, `record_id` and `reasons`.

    One bad line refuses the whole order. `now` is an ISO text or a datetime, the
    same for all records of a run. Documents come parsed as `event`, or as the column `text`,
    which is parsed here, behind the join with the lookups. They are matched by a digest of
    their content, so equal copies simply share the answer. Only the ids that documents
    mention are written for the lookups; the orders themselves pass through once.
    """
    content = F.col(text) if text else F.to_json(F.col(event))
    docs = docs.drop(event) if text else docs
    # What is no document mentions what an empty text does. Half of the digest's bytes tell
    # documents apart and take half the room.
    docs = docs.withColumn("doc_id", F.substring(F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256)), 1, 16))

    def parsed(rows: DataFrame) -> DataFrame:
        return with_columns_once(rows, {event: F.try_parse_json(text)}) if text else rows

    mentions = cut_lineage(_mentions(parsed(docs), event), codec="zstd")
    marked = parsed(_mark_unknown(docs, mentions, customers, products))
    orders = read_orders(marked, event).drop(event).withColumn("_ids", F.col("lines.product_id"))
    return with_columns_once(
        orders, {"reasons": order_reasons(now), "record_id": _record_id("order_id")}
    ).drop("doc_id", "customer_unknown", "unknown_products", "_ids")


# ------------------------------------------------------------------- routing


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by the `reasons` column."""
    return judged.filter(F.size("reasons") == 0), judged.filter(F.size("reasons") > 0)


def rejections(rejected: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    return rejected.select(
        F.lit(source).alias("source"), "record_id", "reasons", "payload", *(keep or [])
    )


def order_lines(valid_orders: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per line of the accepted orders."""
    return valid_orders.select(
        "order_id", *(keep or []), F.explode("lines").alias("line")
    ).select(
        "order_id", *(keep or []), "line.product_id", "line.quantity", "line.unit_price"
    )
