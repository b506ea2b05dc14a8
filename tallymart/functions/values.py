"""Column rules: normalise one value, or say why it is refused.

All of them are plain expressions, so they run inside Spark's own operators and
also inside `transform` over the lines of an order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
ORDER_STATUSES = ["placed", "shipped", "delivered", "cancelled", "returned"]
ORDER_CHANNELS = ["web", "mobile", "store"]
NOT_SALES = ["cancelled", "returned"]
EMAIL_PATTERN = r"(?U)^[^\s@]+@[^\s@]+\.[^\s@]+$"

MAX_INT = 2_147_483_647
AMOUNT_LIMIT = 100_000_000  # amounts are decimal(10,2)

# The white space of Unicode, and what the two sides of the
# contract add to it (separators in the loader, the byte order mark at the door).
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LOADER_SPACE = UNICODE_SPACE + "\x1c\x1d\x1e\x1f\x85"
DOOR_SPACE = UNICODE_SPACE + "\ufeff"


def trimmed(text: Column, space: str = LOADER_SPACE) -> Column:
    """Strips white space from both ends; looks at the ends only."""
    return F.trim(text, F.lit(space))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(trimmed(text), F.lit(""))


def or_marker(text: Column) -> Column:
    return F.when(text == "", F.lit("(empty)")).otherwise(text)


def required(text: Column, field: str) -> Column:
    return F.when(text == "", F.lit(f"{field} is required"))


def email_reason(email: Column) -> Column:
    return F.when(~email.rlike(EMAIL_PATTERN), F.lit("email is not valid"))


def iso_date(text: Column) -> Column:
    """YYYY-MM-DD to a date, anything else to null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


_NUMBER = r"^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,3}))?$"


_PLAIN = r"^\d{1,8}(\.\d{0,2}0*)?$"


def plain_amount(text: Column) -> Column:
    """Amounts as they are usually written, exactly; anything else is null."""
    return F.when(text.rlike(_PLAIN), text.try_cast("decimal(10,2)"))


def number_parts(text: Column) -> Column:
    """A number as text, split: sign, digits before and behind the point, exponent, and
    whether it is one at all. Digits are judged as text, so that rounding in a cast can
    hide nothing."""
    return F.struct(
        text.alias("text"),
        text.rlike(_NUMBER).alias("shaped"),
        F.regexp_extract(text, _NUMBER, 1).alias("sign"),
        F.regexp_extract(text, _NUMBER, 2).alias("whole"),
        F.regexp_extract(text, _NUMBER, 3).alias("fraction"),
        F.coalesce(F.regexp_extract(text, _NUMBER, 4).try_cast("int"), F.lit(0)).alias("exponent"),
    )


def _positive(parts: Column) -> tuple[Column, Column, Column]:
    """Of split numbers: is it zero, is it above zero, and the power of ten of its last
    digit that is not zero."""
    digits = F.concat(parts["whole"], parts["fraction"])
    significant = F.rtrim(digits, F.lit("0"))
    zeros = F.length(digits) - F.length(significant)
    number = parts["shaped"] & (F.length(digits) > 0)
    zero = F.ltrim(significant, F.lit("0")) == ""
    above = number & ~zero & (parts["sign"] != "-")
    return number & zero, above, parts["exponent"] - F.length(parts["fraction"]) + zeros


def _at_least(text: Column, limit: int) -> Column:
    """Beyond the widest decimal a cast gives null, which is too much as well."""
    return F.coalesce(text.try_cast("decimal(38,10)") >= limit, F.lit(True))


def money_of(amount: Column, parts: Column) -> Column:
    """Non-negative amount below AMOUNT_LIMIT with at most two significant decimals, else null.

    `amount` is the plain amount; `parts` is read only where that is null.
    """
    zero, above, last_place = _positive(parts)
    text = parts["text"]
    return (
        F.when(amount.isNotNull(), amount)
        .when(zero, F.lit(0).cast("decimal(10,2)"))
        .when(above & (last_place >= -2) & ~_at_least(text, AMOUNT_LIMIT),
              text.try_cast("decimal(38,10)").try_cast("decimal(10,2)"))
    )


def too_large_of(amount: Column, parts: Column) -> Column:
    """True for an amount that is right but does not fit its column."""
    _, above, last_place = _positive(parts)
    return F.when(amount.isNotNull(), F.lit(False)).otherwise(F.coalesce(
        above & (last_place >= -2) & _at_least(parts["text"], AMOUNT_LIMIT), F.lit(False)))


def whole_number_of(amount: Column, parts: Column) -> Column:
    """Positive whole number up to MAX_INT, else null; 4.0 and 4e0 are 4."""
    _, above, last_place = _positive(parts)
    text = parts["text"]
    return F.when(
        amount.isNotNull(), F.when((amount > 0) & (F.floor(amount) == amount), amount.cast("int"))
    ).when(above & (last_place >= 0) & ~_at_least(text, MAX_INT + 1),
           text.try_cast("decimal(38,10)").cast("int"))


def money(text: Column) -> Column:
    return money_of(plain_amount(text), number_parts(text))


def too_large(text: Column) -> Column:
    return too_large_of(plain_amount(text), number_parts(text))


def whole_number(text: Column) -> Column:
    return whole_number_of(plain_amount(text), number_parts(text))


def whole_number_exact(number: Column) -> Column:
    """`whole_number` of an exact decimal."""
    return F.when((number > 0) & (number <= MAX_INT) & (F.floor(number) == number), number.cast("int"))


def money_exact(number: Column) -> Column:
    """`money` of an exact decimal; one that is rounded by the cast is refused."""
    amount = number.try_cast("decimal(10,2)")
    return F.when((number >= 0) & (amount == number), amount)


def too_large_exact(number: Column) -> Column:
    """`too_large` of an exact decimal with up to 14 digits before the point."""
    return (number >= AMOUNT_LIMIT) & (number.cast("decimal(17,2)") == number)


def moment(text: Column) -> Column:
    """ISO timestamp to a UTC instant; a value without an offset is taken as UTC."""
    shape = (
        r"^\d{4}-\d{2}-\d{2}"
        r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
    )
    day = F.substring(text, 1, 10)
    clock = F.regexp_extract(text, r"^.{10}[T ](\d{2}(?::\d{2}(?::\d{2})?)?)", 1)
    full_clock = F.concat(
        clock, F.when(F.length(clock) == 2, ":00:00").when(F.length(clock) == 5, ":00").otherwise("")
    )
    micros = F.rpad(F.substring(F.regexp_extract(text, r"[.,](\d+)", 1), 1, 6), 6, "0")
    zone = F.regexp_extract(text, r"^.{11,}?([+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)$", 1)
    colon_zone = F.when(zone == "", F.lit("Z")).otherwise(
        F.concat(
            F.substring(zone, 1, 3),
            F.lit(":"),
            F.rpad(F.substring(F.regexp_replace(zone, "[+:-]", ""), 3, 2), 2, "0"),
            F.when(
                F.length(F.regexp_replace(zone, "[+:-]", "")) == 6,
                F.concat(F.lit(":"), F.substring(F.regexp_replace(zone, "[+:-]", ""), 5, 2)),
            ).otherwise(""),
        )
    )
    instant = F.when(F.length(text) == 10, F.concat(day, F.lit("T00:00:00Z"))).otherwise(
        F.concat(day, F.lit("T"), full_clock, F.lit("."), micros, colon_zone)
    )
    usual = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$")
    return F.when(usual, text.try_cast("timestamp")).when(
        text.rlike(shape), instant.try_cast("timestamp")
    )


def known_word_reason(value: Column, words: list[str], label: str) -> Column:
    return F.when(~value.isin(words), F.concat(F.lit(f"unknown {label} "), or_marker(value)))


def is_sale(status: Column) -> Column:
    """Cancelled and returned orders are not sales."""
    return ~status.isin(NOT_SALES)


def date_key(day: Column) -> Column:
    """20260131 for 31 January 2026, by arithmetic."""
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def line_revenue(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast("decimal(12,2)")


def line_cost(quantity: Column, unit_cost: Column) -> Column:
    return (quantity * unit_cost).cast("decimal(12,2)")


def line_margin(quantity: Column, unit_price: Column, unit_cost: Column) -> Column:
    return (quantity * (unit_price - unit_cost)).cast("decimal(12,2)")
