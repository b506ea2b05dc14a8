"""Structural contract of an order event, before any business rule.

Only the shape is judged here: fields, types, lengths, no unknown keys. Wrong
values (an unknown customer, a negative quantity) pass and are reported later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.operators.once import with_columns_once

# Fixed values of the contract: (field, shortest, longest).
TEXT_FIELDS = [
    ("order_id", 1, 64),
    ("customer_id", 0, 64),
    ("status", 0, 32),
    ("channel", 0, 32),
    ("ordered_at", 0, 40),
]
ITEM_TEXT_FIELDS = [("product_id", 0, 64)]
ITEM_NUMBER_FIELDS = ["quantity", "unit_price"]
MAX_ITEMS = 200
ORDER_KEYS = [name for name, *_ in TEXT_FIELDS] + ["items"]
ITEM_KEYS = [name for name, *_ in ITEM_TEXT_FIELDS] + ITEM_NUMBER_FIELDS


def trimmed(text: Column) -> Column:
    return v.trimmed(text, v.DOOR_SPACE)


def kind(value: Column) -> Column:
    """Bare type of a variant: STRING, BIGINT, DECIMAL, OBJECT, ...; null if missing."""
    schema = F.schema_of_variant(value)
    return F.substring_index(F.substring_index(schema, "<", 1), "(", 1)


def _json_type(kind_name: Column) -> Column:
    """Name of a bare type in messages."""
    return (
        F.when(kind_name == "VOID", "null")
        .when(kind_name.isin("STRING", "BOOLEAN", "OBJECT", "ARRAY"), F.lower(kind_name))
        .otherwise("number")
    )


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: characters beyond the basic plane count twice."""
    return F.shiftright(F.octet_length(F.encode(text, "UTF-16BE")), 1)


# The types of an event as nearly all have them: every contract field there, none besides.
# Types of items are merged, so a null among them does not show here.
_NUMBER = r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
# Numbers that a decimal(18,4) holds exactly, or, where they are too long for it, not at all.
_SHORT_DECIMAL = r"(?:BIGINT|DECIMAL\(\d+,[0-4]\))"


def _usual_types(number: str) -> str:
    item = ", ".join(
        f"{name}: {number if name in ITEM_NUMBER_FIELDS else 'STRING'}" for name in sorted(ITEM_KEYS))
    order = ", ".join(
        f"{name}: " + (f"ARRAY<(?:VOID|OBJECT<{item}>)>" if name == "items" else "STRING")
        for name in sorted(ORDER_KEYS))
    return rf"\AOBJECT<{order}>\z"


def usual_order(event: Column, typed: bool = False) -> Column:
    """The fields of an event whose fields are all there and of the right types, read in one
    go; null for any other event.

    Numbers stay variants; with `typed` they are exact decimals, and an event with a number
    that is none counts as another one.
    """
    number = "decimal(18,4)" if typed else "variant"
    lines = ", ".join(f"{name}: {number if name in ITEM_NUMBER_FIELDS else 'string'}" for name in ITEM_KEYS)
    fields = ", ".join(
        f"{name}: " + (f"array<struct<{lines}>>" if name == "items" else "string") for name in ORDER_KEYS)
    read = F.when(F.schema_of_variant(event).rlike(_usual_types(_SHORT_DECIMAL if typed else _NUMBER)),
                  F.try_variant_get(event, "$", f"struct<{fields}>"))

    def there(item: Column) -> Column:
        known = [item[name].isNotNull() for name in ITEM_KEYS]
        known += [] if typed else [~F.is_variant_null(item[name]) for name in ITEM_NUMBER_FIELDS]
        return reduce(lambda a, b: a & b, known)

    whole = F.filter(F.array(read), lambda order: order["items"].isNotNull() & F.forall(order["items"], there))
    return F.try_element_at(whole, F.lit(1))


def _in_bounds(text: Column, least: int, most: int) -> Column:
    """Surely within its lengths: no text has more UTF-16 units than bytes."""
    short = F.octet_length(text) <= most
    return short & (trimmed(text) != "") if least else short


def _usual_and_short(order: Column) -> Column:
    """A usual order that breaks no rule of the contract; null for any other."""
    checks = [_in_bounds(order[name], least, most) for name, least, most in TEXT_FIELDS]
    checks.append(F.size(order["items"]) <= MAX_ITEMS)
    checks.append(F.forall(order["items"], lambda item: reduce(
        lambda a, b: a & b, [_in_bounds(item[name], least, most) for name, least, most in ITEM_TEXT_FIELDS])))
    return F.when(reduce(lambda a, b: a & b, checks), order)


# `concat` gives null for a null message, and null messages are dropped, so each
# error below is written once and evaluated once.


def _is(kind_name: Column, expected: str) -> Column:
    if expected == "number":
        return ~kind_name.isin("VOID", "STRING", "BOOLEAN", "OBJECT", "ARRAY")
    return kind_name == expected.upper()


def _type_error(kind_name: Column, expected: str) -> Column:
    right = _is(kind_name, expected)
    return F.when(kind_name.isNull(), F.lit("Required")).when(
        ~right, F.concat(F.lit(f"Expected {expected}, received "), _json_type(kind_name))
    )


def _at(path: Column, message: Column) -> Column:
    return F.concat(path, F.lit(": "), message)


def _text_facts(owner: Column, fields: list) -> list[Column]:
    return [
        F.struct(
            kind(field(owner, name)).alias("kind"),
            utf16_length(trimmed(F.try_variant_get(owner, f"$.{name}", "string"))).alias("size"),
        ).alias(name)
        for name, *_ in fields
    ]


def _extra_keys(owner: Column, allowed: list[str]) -> Column:
    keys = F.map_keys(F.try_variant_get(owner, "$", "map<string,variant>"))
    return F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))


def _text_errors(fact: Column, path: Column, least: int, most: int) -> list[Column]:
    is_text = fact["kind"] == "STRING"
    errors = [_at(path, _type_error(fact["kind"], "string"))]
    if least:
        errors.append(_at(path, F.when(
            is_text & (fact["size"] < least),
            F.lit(f"String must contain at least {least} character(s)"))))
    errors.append(_at(path, F.when(
        is_text & (fact["size"] > most),
        F.lit(f"String must contain at most {most} character(s)"))))
    return errors


def _unknown_keys(keys: Column, path: Column) -> Column:
    quoted = F.array_join(F.transform(keys, lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", ")
    message = F.concat(F.lit("Unrecognized key(s) in object: "), quoted)
    return F.when(F.size(keys) > 0, _at(path, message))


def _item_facts(item: Column) -> Column:
    return F.struct(
        kind(item).alias("kind"),
        *_text_facts(item, ITEM_TEXT_FIELDS),
        *[kind(field(item, name)).alias(name) for name in ITEM_NUMBER_FIELDS],
        _extra_keys(item, ITEM_KEYS).alias("extra"),
    )


NO_ERRORS = "array<string>"


def _good_texts(fact: Column, fields: list) -> Column:
    return reduce(
        lambda a, b: a & b,
        [(fact[n]["kind"] == "STRING") & fact[n]["size"].between(least, most)
         for n, least, most in fields],
    )


def _good_item(fact: Column) -> Column:
    """Most items are well formed; one cheap test spares them the messages."""
    numbers = [_is(fact[name], "number") for name in ITEM_NUMBER_FIELDS]
    return reduce(
        lambda a, b: a & b,
        [fact["kind"] == "OBJECT", _good_texts(fact, ITEM_TEXT_FIELDS), *numbers,
         F.size(fact["extra"]) == 0],
    )


def _item_errors(fact: Column, position: Column) -> Column:
    base = F.concat(F.lit("items."), position.cast("string"))
    at = lambda name: F.concat(base, F.lit(f".{name}"))
    checks = [
        error
        for name, least, most in ITEM_TEXT_FIELDS
        for error in _text_errors(fact[name], at(name), least, most)
    ]
    checks += [_at(at(name), _type_error(fact[name], "number")) for name in ITEM_NUMBER_FIELDS]
    checks.append(_unknown_keys(fact["extra"], base))
    return (
        F.when(_good_item(fact), F.array().cast(NO_ERRORS))
        .when(fact["kind"] == "OBJECT", F.array_compact(F.array(*checks)))
        .otherwise(F.array(_at(base, _type_error(fact["kind"], "object"))))
    )


def judge_shape(events: DataFrame) -> DataFrame:
    """Adds `errors`, all shape errors of the variant `event` in field order."""
    return _judge(events).drop("_order")


def _judge(events: DataFrame) -> DataFrame:
    """Adds `errors` and `_order`, the fields of an event that is found right at once.

    The types and lengths of any other event are read once into a helper column; the
    messages only look at that column.
    """
    event = F.col("event")
    items = F.try_variant_get(event, "$.items", "array<variant>")
    facts = F.struct(
        kind(event).alias("kind"),
        *_text_facts(event, TEXT_FIELDS),
        kind(field(event, "items")).alias("items"),
        F.transform(items, _item_facts).alias("lines"),
        _extra_keys(event, ORDER_KEYS).alias("extra"),
    )
    fact = F.col("_facts")
    header = [
        error
        for name, least, most in TEXT_FIELDS
        for error in _text_errors(fact[name], F.lit(name), least, most)
    ]
    header.append(_at(F.lit("items"), _type_error(fact["items"], "array")))
    header.append(_at(F.lit("items"), F.when(
        F.size(fact["lines"]) > MAX_ITEMS,
        F.lit(f"Array must contain at most {MAX_ITEMS} element(s)"))))
    good_header = (
        _good_texts(fact, TEXT_FIELDS)
        & (fact["items"] == "ARRAY")
        & (F.size(fact["lines"]) <= MAX_ITEMS)
    )
    found = F.concat(
        F.when(good_header, F.array().cast(NO_ERRORS)).otherwise(
            F.array_compact(F.array(*header))
        ),
        F.coalesce(F.flatten(F.transform(fact["lines"], _item_errors)),
                   F.array().cast(NO_ERRORS)),
        F.array_compact(F.array(_unknown_keys(fact["extra"], F.lit("order")))),
    )
    errors = (
        F.when(F.col("_order").isNotNull(), F.array().cast(NO_ERRORS))
        .when(event.isNull(), F.array(F.lit("Body is not valid JSON")))
        .when(fact["kind"] == "OBJECT", found)
        .otherwise(F.array(_at(F.lit("order"), _type_error(fact["kind"], "object"))))
    )
    usual = with_columns_once(events, {"_order": usual_order(event)})
    usual = with_columns_once(usual.withColumnRenamed("_order", "_usual"), {"_order": _usual_and_short(F.col("_usual"))})
    read_once = with_columns_once(usual.drop("_usual"), {"_facts": F.when(F.col("_order").isNull(), facts)})
    return with_columns_once(read_once, {"errors": errors}).drop("_facts")


def parse_events(lines: DataFrame, text: str = "value") -> DataFrame:
    """Adds the variant column `event`; broken JSON gives null."""
    return with_columns_once(lines, {"event": F.try_parse_json(text)})


def trimmed_document(event: Column) -> Column:
    """The event as JSON text with its contract strings trimmed, for storage."""
    items = F.try_variant_get(event, "$.items", "array<variant>")
    return F.to_json(
        F.struct(
            *[trimmed(F.try_variant_get(event, f"$.{name}", "string")).alias(name)
              for name, *_ in TEXT_FIELDS],
            F.transform(
                items,
                lambda item: F.struct(
                    *[trimmed(F.try_variant_get(item, f"$.{name}", "string")).alias(name)
                      for name, *_ in ITEM_TEXT_FIELDS],
                    *[field(item, name).alias(name) for name in ITEM_NUMBER_FIELDS],
                ),
            ).alias("items"),
        )
    )


def _usual_document(order: Column) -> Column:
    """The same text from the fields that were read already."""
    return F.to_json(
        F.struct(
            *[trimmed(order[name]).alias(name) for name, *_ in TEXT_FIELDS],
            F.transform(
                order["items"],
                lambda item: F.struct(
                    *[trimmed(item[name]).alias(name) for name, *_ in ITEM_TEXT_FIELDS],
                    *[item[name].alias(name) for name in ITEM_NUMBER_FIELDS],
                ),
            ).alias("items"),
        )
    )


def check_shape(events: DataFrame, position: str = "position") -> tuple[DataFrame, DataFrame]:
    """Splits parsed events into (accepted, refused).

    `accepted` keeps `position` and gains `order_id` and the stored `doc`;
    `refused` holds `index` (the position), `errors` and the `text` as it came.
    """
    routed = route_shape(events, position)
    return (
        routed.filter("right").select(position, "order_id", "doc"),
        routed.filter("NOT right").select(F.col(position).alias("index"), "errors", "text"),
    )


def route_shape(events: DataFrame, position: str = "position") -> DataFrame:
    """Accepted and refused events side by side: `right` says which; either kind has its own
    columns filled and those of the other null."""
    order, right = F.col("_order"), F.col("right")
    judged = _judge(events).withColumn("right", F.size("errors") == 0)
    text = F.col("value") if "value" in judged.columns else F.to_json("event")
    return judged.select(
        position,
        right,
        F.when(right & order.isNotNull(), trimmed(order["order_id"]))
        .when(right, trimmed(F.try_variant_get("event", "$.order_id", "string"))).alias("order_id"),
        F.when(right & order.isNotNull(), _usual_document(order))
        .when(right, trimmed_document(F.col("event"))).alias("doc"),
        "errors",
        F.when(~right, text).alias("text"),
    )
