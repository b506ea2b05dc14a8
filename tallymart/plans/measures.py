"""Business measures, evaluated in any filter and by any columns of the star.

`measure(star, names, by, where)` builds one plan: filter, join only the
dimensions that are named, aggregate. Columns are written `table.column`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import values as v
from tallymart.plans.star import Star

FACT, DATES, CUSTOMERS, PRODUCTS, SEGMENTS = (
    "fact_order_items", "dim_date", "dim_customer", "dim_product", "customer_segments"
)
DIMENSION_KEYS = {DATES: "date_key", CUSTOMERS: "customer_key", PRODUCTS: "product_key"}

# The semantic layer's own names for the money columns of a line.
MEASURE_COLUMNS = {"revenue": "line_revenue", "cost": "line_cost", "margin": "line_margin"}

MONEY_BASES = ("revenue", "margin", "units")
ORDER_BASES = ("orders", "all_orders", "returned_orders")

# measure -> the base sums it needs
NEEDS: dict[str, tuple[str, ...]] = {
    "Revenue": ("revenue",),
    "Margin": ("margin",),
    "Margin %": ("revenue", "margin"),
    "Orders": ("orders",),
    "Average Order Value": ("revenue", "orders"),
    "Daily Revenue": ("revenue", "days"),
    "Daily Margin": ("margin", "days"),
    "Units": ("units",),
    "Revenue Previous Month": ("previous",),
    "Revenue MoM %": ("revenue", "previous"),
    "Return Rate": ("all_orders", "returned_orders"),
    "Customers": ("customers",),
}
# These replace a filter on the order status by their own.
OWN_STATUS_FILTER = set(NEEDS) - {"Customers", "Return Rate"}

Predicate = Callable[[Column], Column]


def _ratio(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def _formula(name: str) -> Column:
    formulas: dict[str, Callable[[], Column]] = {
        "Revenue": lambda: F.col("revenue"),
        "Margin": lambda: F.col("margin"),
        "Margin %": lambda: _ratio("margin", "revenue"),
        "Orders": lambda: F.col("orders"),
        "Average Order Value": lambda: _ratio("revenue", "orders"),
        "Daily Revenue": lambda: _ratio("revenue", "days"),
        "Daily Margin": lambda: _ratio("margin", "days"),
        "Units": lambda: F.col("units"),
        "Revenue Previous Month": lambda: F.col("previous"),
        "Revenue MoM %": lambda: F.when(
            F.col("previous").isNotNull(),
            F.try_divide(
                (F.col("revenue") - F.col("previous")).cast("double"),
                F.col("previous").cast("double"),
            ),
        ),
        "Return Rate": lambda: _ratio("returned_orders", "all_orders"),
        "Customers": lambda: F.col("customers"),
    }
    return formulas[name]()


def semantic_fact(fact: DataFrame) -> DataFrame:
    """The fact under the names the semantic layer uses."""
    return fact.withColumnsRenamed(MEASURE_COLUMNS)


def _split(column: str) -> tuple[str, str]:
    owner, _, name = column.partition(".")
    if not name:
        raise ValueError(f"write table.column, not {column!r}")
    return owner, name


class _Context:
    """Filters and groups, resolved to frames keyed for a join with the fact."""

    def __init__(self, star: Star, by: Sequence[str], where: Mapping[str, Predicate]):
        self.star = star
        self.by = [_split(c) for c in by]
        self.where = [(*_split(c), test) for c, test in where.items()]
        labels = [name for _, name in self.by]
        if len(set(labels)) != len(labels):
            raise ValueError("two groups share a column name")
        self.labels = labels

    def _calendar(self) -> DataFrame:
        return self.star.dim_date.withColumn("year_month", v.year_month(F.col("full_date")))

    def _customers(self, extra: bool) -> DataFrame:
        people = self.star.dim_customer
        if not extra:
            return people
        scores = self.star.customer_segments.drop("name", "country")
        return people.join(scores, "customer_id", "left")

    def _touches(self, owner: str) -> bool:
        return any(o == owner for o, _ in self.by) or any(o == owner for o, *_ in self.where)

    def filtered(self, owner: str) -> DataFrame:
        """One dimension with its filters; segments hang on the customer."""
        owners = {owner}
        if owner == DATES:
            frame = self._calendar()
        elif owner == CUSTOMERS:
            with_segments = self._touches(SEGMENTS)
            frame = self._customers(with_segments)
            owners.add(SEGMENTS)
        else:
            frame = getattr(self.star, owner)
        for where_owner, name, test in self.where:
            if where_owner in owners:
                frame = frame.filter(test(F.col(name)))
        return frame

    def groups_of(self, *owners: str) -> list[str]:
        return [name for owner, name in self.by if owner in owners]

    def slice_fact(self, dates: DataFrame | None = None) -> DataFrame:
        """Fact lines in the filter context, with the group columns attached.

        `dates`, if given, replaces the calendar (a shifted month, for example).
        """
        fact = self.star.fact_order_items
        for owner, name, test in self.where:
            if owner == FACT:
                fact = fact.filter(test(F.col(name)))
        wanted = {"order_id", "status", "quantity", "revenue", "margin", *DIMENSION_KEYS.values()}
        fact = fact.select(*(wanted | set(self.groups_of(FACT))))
        if dates is None and self._touches(DATES):
            dates = self.filtered(DATES).select("date_key", *self.groups_of(DATES))
        if dates is not None:
            fact = fact.join(dates, "date_key")
        if self._touches(CUSTOMERS) or self._touches(SEGMENTS):
            people = self.filtered(CUSTOMERS)
            fact = fact.join(
                people.select("customer_key", *self.groups_of(CUSTOMERS, SEGMENTS)), "customer_key"
            )
        if self._touches(PRODUCTS):
            goods = self.filtered(PRODUCTS)
            fact = fact.join(goods.select("product_key", *self.groups_of(PRODUCTS)), "product_key")
        return fact

    def base_sums(self, lines: DataFrame, bases: set[str]) -> DataFrame:
        """Sums of the context. Orders are first reduced to one row per group and
        order, so several distinct counts need neither a wide expand nor a set
        held in one task."""
        sale = v.is_sale(F.col("status"))
        source = {"revenue": "revenue", "margin": "margin", "units": "quantity"}
        sums = [
            F.sum(F.when(sale, F.col(source[b]))).alias(b) for b in MONEY_BASES if b in bases
        ]
        if not bases & set(ORDER_BASES):
            return lines.groupBy(*self.labels).agg(*sums)
        per_order = lines.groupBy(*self.labels, "order_id").agg(
            *sums,
            F.max(sale).alias("_sold"),
            F.max(F.col("status") == "returned").alias("_returned"),
        )
        return per_order.groupBy(*self.labels).agg(
            *[F.sum(b).alias(b) for b in MONEY_BASES if b in bases],
            F.count_if("_sold").alias("orders"),
            F.count("*").alias("all_orders"),
            F.count_if("_returned").alias("returned_orders"),
        )

    def days(self) -> DataFrame:
        """Calendar days of each group; groups of other tables do not filter the calendar."""
        return self.filtered(DATES).groupBy(*self.groups_of(DATES)).agg(
            F.count("*").alias("days")
        )

    def previous_month_dates(self) -> DataFrame:
        """Each day of a group moved back one month, if the calendar has that day.

        A group that holds a whole month takes the whole month before, so the
        31st of a short month is not lost.
        """
        labels = self.groups_of(DATES)
        days = self.filtered(DATES).select(
            "full_date", *[F.col(c).alias(f"_{c}") for c in labels]
        )
        marks = [f"_{c}" for c in labels]
        month = F.trunc("full_date", "month")
        months = days.groupBy(*marks, month.alias("_month")).agg(
            F.countDistinct("full_date").alias("_held")
        )
        whole = months.filter(F.col("_held") == F.dayofmonth(F.last_day("_month")))
        by_month = whole.select(
            *marks,
            F.explode(
                F.sequence(
                    F.add_months("_month", -1),
                    F.last_day(F.add_months("_month", -1)),
                )
            ).alias("full_date"),
        )
        partial = months.filter(F.col("_held") != F.dayofmonth(F.last_day("_month")))
        same = reduce(
            lambda a, b: a & b,
            [days[m].eqNullSafe(partial[m]) for m in marks],
            F.trunc(days["full_date"], "month") == partial["_month"],
        )
        by_day = days.join(partial, same, "left_semi").select(
            *marks, F.add_months("full_date", -1).alias("full_date")
        )
        moved = by_month.unionByName(by_day).distinct()
        return (
            moved.join(self.star.dim_date.select("date_key", "full_date"), "full_date")
            .select("date_key", *[F.col(m).alias(c) for m, c in zip(marks, labels)])
        )

    def segment_customers(self) -> DataFrame:
        """Customers with a segment. Filters on the customer or the segment reach
        them, filters on the fact, the product or the date do not."""
        people = self.filtered(CUSTOMERS)
        labels = self.groups_of(CUSTOMERS, SEGMENTS)
        known = self.star.customer_segments
        if self._touches(SEGMENTS):
            rows = people.filter(F.col("segment").isNotNull())
        else:
            rows = people.join(known.select("customer_id"), "customer_id", "left_semi")
        return rows.groupBy(*labels).agg(F.count("*").alias("customers"))


def _attach(left: DataFrame, right: DataFrame, labels: list[str]) -> DataFrame:
    """Two grouped results side by side, groups of either side kept.

    A union and one aggregation: null groups meet, and no join is needed.
    """
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*labels).agg(
        *[F.max(c).alias(c) for c in both.columns if c not in labels]
    )


def measure(
    star: Star,
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Predicate] | None = None,
) -> DataFrame:
    """One row per group with the named measures; a blank measure is null."""
    unknown = [n for n in names if n not in NEEDS]
    if unknown:
        raise ValueError(f"unknown measures {unknown}")
    if "fact_order_items.status" in by and OWN_STATUS_FILTER & set(names):
        raise ValueError("sales measures replace the status filter; do not group them by status")
    where = dict(where or {})
    context = _Context(star, by, where)
    status_filter = where.pop("fact_order_items.status", None)
    if status_filter is not None and OWN_STATUS_FILTER & set(names):
        if set(names) - OWN_STATUS_FILTER:
            raise ValueError("ask for sales measures and others separately under a status filter")
        context = _Context(star, by, where)
    bases = {base for name in names for base in NEEDS[name]}
    labels = context.labels

    result: DataFrame | None = None
    if bases & {*MONEY_BASES, *ORDER_BASES}:
        result = context.base_sums(context.slice_fact(), bases)
    if "previous" in bases:
        before = context.base_sums(
            context.slice_fact(context.previous_month_dates()), {"revenue"}
        ).withColumnRenamed("revenue", "previous")
        result = before if result is None else _attach(result, before, labels)
    if "customers" in bases:
        result = _with_customers(context, result, labels)
    if "days" in bases:
        result = _with_days(context, result)
    return result.select(*labels, *[_formula(n).alias(n) for n in names])


def _with_customers(context: _Context, result: DataFrame | None, labels: list[str]) -> DataFrame:
    counts = context.segment_customers()
    if result is None and set(counts.columns) - {"customers"} == set(labels):
        return counts
    if result is None:
        raise ValueError("Customers alone can only be grouped by customer or segment columns")
    shared = [c for c in labels if c in counts.columns]
    if shared == labels:
        return _attach(result, counts, labels)
    if not shared:
        return result.withColumn("customers", counts.scalar())
    return result.join(counts, shared, "left")


def _with_days(context: _Context, result: DataFrame) -> DataFrame:
    days = context.days()
    shared = context.groups_of(DATES)
    if not shared:
        return result.withColumn("days", days.scalar())
    return result.join(days, shared, "left")


# ------------------------------------------------------------- report pages


def _cards(*names: str) -> Callable[[Star], DataFrame]:
    return lambda star: measure(star, names)


def slicer(star: Star, column: str) -> DataFrame:
    """The values a reader can pick from."""
    owner, name = _split(column)
    return getattr(star, owner).select(name).distinct().orderBy(name)


PAGES: dict[str, Callable[[Star], DataFrame]] = {
    "card_revenue": _cards("Revenue"),
    "card_margin_pct": _cards("Margin %"),
    "card_orders": _cards("Orders"),
    "card_aov": _cards("Average Order Value"),
    "daily_by_month": lambda star: measure(
        star, ["Daily Revenue", "Daily Margin"], by=["dim_date.year_month"]
    ).orderBy("year_month"),
    "revenue_by_category": lambda star: measure(
        star, ["Revenue"], by=["dim_product.category"]
    ).orderBy(F.desc("Revenue")),
    "by_channel": lambda star: measure(
        star, ["Revenue", "Margin"], by=["fact_order_items.channel"]
    ).orderBy(F.desc("Revenue")),
    "slicer_channel": lambda star: slicer(star, "fact_order_items.channel"),
    "slicer_country": lambda star: slicer(star, "dim_customer.country"),
    "product_table": lambda star: measure(
        star, ["Units", "Revenue", "Margin %"], by=["dim_product.name", "dim_product.category"]
    ).orderBy(F.desc("Revenue")),
    "customers_by_segment": lambda star: measure(
        star, ["Customers"], by=["customer_segments.segment"]
    ),
    "revenue_by_country": lambda star: measure(
        star, ["Revenue"], by=["dim_customer.country"]
    ).orderBy(F.desc("Revenue")),
}
