"""SQL counterparts of the queries, written on their own for a second engine."""

from __future__ import annotations

ITEM = """
item AS (
  SELECT l_orderkey, l_partkey, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(10,0)) * 0.01
              AS DECIMAL(10,2)) AS unit_price,
         l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate
  FROM lineitem)"""

ORD = """
ord AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 10 = 0 THEN 'cancelled' WHEN o_orderkey % 10 = 1 THEN 'returned'
              WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'shipped'
              ELSE 'placed' END AS status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'mobile' ELSE 'store' END AS channel,
         o_orderdate, CAST(o_orderdate AS DATE) AS order_date
  FROM orders)"""

GOOD = """
good AS (
  SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
         p_type AS category, p_size,
         CAST(CAST(floor(p_retailprice * 60) AS DECIMAL(10,0)) * 0.01 AS DECIMAL(10,2)) AS unit_cost
  FROM part)"""

PERSON = """
person AS (
  SELECT c_custkey AS customer_key, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         n_name AS country, c_mktsegment
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""

CAL = """
cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS full_date,
         year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
         isodow(d) AS day_of_week, isodow(d) >= 6 AS is_weekend, strftime(d, '%Y-%m') AS year_month
  FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d
        FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders)))"""

FACT = """
fact AS (
  SELECT item.order_id, product_key, item.product_id, o_custkey AS customer_key, customer_id,
         CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, status, channel, quantity,
         unit_price, CAST(quantity * unit_price AS DECIMAL(12,2)) AS revenue,
         CAST(quantity * unit_cost AS DECIMAL(12,2)) AS cost,
         CAST(quantity * (unit_price - unit_cost) AS DECIMAL(12,2)) AS margin, order_date
  FROM item JOIN ord ON o_orderkey = l_orderkey JOIN good ON product_key = l_partkey)"""

SALES = "sales AS (SELECT * FROM fact WHERE status NOT IN ('cancelled', 'returned'))"

STAR = ", ".join([ITEM, ORD, GOOD, PERSON, CAL, FACT, SALES])

# Exact half-up rounding of 100 * a / b to two places, for decimals with two places.
PCT = """
  CAST(sign({a}) * ((2 * 10000 * CAST(abs({a}) * 100 AS HUGEINT) + CAST({b} * 100 AS HUGEINT))
       // (2 * CAST({b} * 100 AS HUGEINT))) AS DOUBLE) / 100"""
# Exact half-up rounding of a / n to two places, for an amount with two places.
AVG2 = """
  CAST((2 * CAST({a} * 100 AS HUGEINT) + CAST({n} AS HUGEINT)) // (2 * CAST({n} AS HUGEINT))
       AS DOUBLE) / 100"""


def money(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS DOUBLE) AS {n}" for n in names)


def with_star(select: str, *extra: str) -> str:
    """`select` may start with further CTEs, introduced by 'ALSO'."""
    head = f"WITH {', '.join([STAR, *extra])}"
    body = select.strip()
    return f"{head}, {body[5:]}" if body.startswith("ALSO ") else f"{head} {body}"


MONTHLY = f"""
  SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, year_month,
         count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
         {money('revenue', 'margin')},
         {PCT.format(a='sum(margin)', b='sum(revenue)')} AS margin_pct
  FROM {{sales}} JOIN cal USING (date_key) GROUP BY year, month, year_month"""

PRODUCTS = f"""
  SELECT product_id, name, category, count(DISTINCT order_id) AS orders,
         CAST(sum(quantity) AS BIGINT) AS units, {money('revenue', 'margin')},
         rank() OVER (ORDER BY sum(revenue) DESC) AS revenue_rank
  FROM sales JOIN good USING (product_id) GROUP BY product_id, name, category"""


# The tile of each place k (from 1) among n rows in four tiles; the first n % 4 are longer by one.
_TILE = """CASE WHEN {k} <= (n % 4) * (n // 4 + 1) THEN ({k} - 1) // (n // 4 + 1) + 1
         ELSE n % 4 + ({k} - 1 - (n % 4) * (n // 4 + 1)) // greatest(n // 4, 1) + 1 END"""
# Fixed values of the segment rule: lowest and highest score per measure; the first row that fits counts.
_RULES = [
    ("champion", (4, 4), (3, 4), (3, 4)),
    ("loyal", (3, 4), (2, 4), (1, 4)),
    ("new", (4, 4), (1, 4), (1, 4)),
    ("at risk", (1, 2), (1, 4), (3, 4)),
    ("occasional", (1, 4), (1, 4), (1, 4)),
]


def segments(sales: str = "sales", people: str = "person") -> str:
    rules = ", ".join(f"({i}, '{n}', {r[0]}, {r[1]}, {f[0]}, {f[1]}, {m[0]}, {m[1]})"
                      for i, (n, r, f, m) in enumerate(_RULES))
    places = ", ".join(f"row_number() OVER (ORDER BY {by}, customer_id) AS at_{by}"
                       for by in ("last_order_date", "orders", "revenue"))
    tiles = ", ".join(f"({_TILE.format(k='at_' + by)})::INT AS {name}" for by, name in (
        ("last_order_date", "recency_score"), ("orders", "frequency_score"), ("revenue", "monetary_score")))
    return f"""
baskets AS (
  SELECT customer_id, order_id, max(order_date) AS day, sum(revenue) AS paid FROM {sales} GROUP BY 1, 2),
buyers AS (
  SELECT customer_id, max(day) AS last_order_date, count(*) AS orders, sum(paid) AS revenue
  FROM baskets GROUP BY 1),
placed AS (SELECT *, {places}, count(*) OVER () AS n FROM buyers JOIN {people} USING (customer_id)),
tiled AS (SELECT *, {tiles} FROM placed),
rules(priority, segment, r0, r1, f0, f1, m0, m1) AS (VALUES {rules}),
fitting AS (
  SELECT customer_id AS fit, arg_min(segment, priority) AS segment FROM tiled JOIN rules
    ON recency_score BETWEEN r0 AND r1 AND frequency_score BETWEEN f0 AND f1 AND monetary_score BETWEEN m0 AND m1
  GROUP BY 1),
segments AS (SELECT * FROM tiled JOIN fitting ON fit = customer_id)"""


SEGMENTS_OUT = """
  SELECT customer_id, name, country, last_order_date, orders, CAST(revenue AS DOUBLE) AS revenue,
         recency_score, frequency_score, monetary_score, segment FROM segments"""

SELL = "status NOT IN ('cancelled', 'returned')"
_R = f"sum(revenue) FILTER ({SELL})"
_M = f"sum(margin) FILTER ({SELL})"
_O = f"count(DISTINCT order_id) FILTER ({SELL})"
MEASURE = {
    "revenue": f"CAST({_R} AS DOUBLE)",
    "margin": f"CAST({_M} AS DOUBLE)",
    "margin_pct": f"CAST({_M} AS DOUBLE) / nullif(CAST({_R} AS DOUBLE), 0)",
    "orders": _O,
    "average_order_value": f"CAST({_R} AS DOUBLE) / nullif(CAST({_O} AS DOUBLE), 0)",
    "units": f"CAST(sum(quantity) FILTER ({SELL}) AS BIGINT)",
    "return_rate": "CAST(count(DISTINCT order_id) FILTER (status = 'returned') AS DOUBLE)"
                   " / nullif(CAST(count(DISTINCT order_id) AS DOUBLE), 0)",
}
SALES_SET = list(MEASURE)


def measured(names: list[str], source: str, by: list[str], extra: str = "") -> str:
    columns = [*by, *[f"{MEASURE[n]} AS {n}" for n in names], *([extra] if extra else [])]
    tail = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {', '.join(columns)} FROM {source}{tail}"


def per_day(measure: str, days: str) -> str:
    return f"{MEASURE[measure]} / {days} AS daily_{measure}"


MONTH_DAYS = "(SELECT CAST(count(*) AS DOUBLE) FROM cal c WHERE c.year_month = m.year_month)"

PREVIOUS = f"""
held AS (
  SELECT year_month, min(full_date) AS first, count(*) AS n,
         count(*) = date_diff('day', date_trunc('month', min(full_date)),
                              date_trunc('month', min(full_date)) + INTERVAL 1 MONTH) AS whole
  FROM cal GROUP BY year_month),
moved AS (
  SELECT DISTINCT year_month, CAST(full_date - INTERVAL 1 MONTH AS DATE) AS day
  FROM cal JOIN held USING (year_month) WHERE NOT whole
  UNION
  SELECT h.year_month, p.full_date FROM held h JOIN cal p
    ON p.full_date >= date_trunc('month', h.first) - INTERVAL 1 MONTH
   AND p.full_date < date_trunc('month', h.first) WHERE h.whole),
now_rev AS (
  SELECT year_month, sum(revenue) FILTER ({SELL}) AS revenue
  FROM fact JOIN cal USING (date_key) GROUP BY year_month),
prev_rev AS (
  SELECT moved.year_month, sum(revenue) FILTER ({SELL}) AS previous
  FROM fact JOIN moved ON moved.day = fact.order_date GROUP BY moved.year_month)"""

O: dict[str, str] = {}
ORACLES = O

O["monthly_revenue"] = with_star(MONTHLY.format(sales="sales"))
O["product_performance"] = O["product_performance_distributed"] = with_star(PRODUCTS)
O["customer_segments"] = O["customer_segments_distributed"] = with_star(SEGMENTS_OUT, segments())
O["sales_by_country_channel"] = with_star(f"""
  SELECT country, channel, count(DISTINCT order_id) AS orders, {money('revenue')},
         {AVG2.format(a='sum(revenue)', n='count(DISTINCT order_id)')} AS average_order_value
  FROM sales JOIN person USING (customer_id) GROUP BY country, channel""")
O["report_monthly_revenue"] = with_star(
    f"SELECT year_month, orders, units, revenue, margin, margin_pct FROM"
    f" ({MONTHLY.format(sales='sales')}) ORDER BY year_month")
O["report_top_products"] = with_star(f"""
  SELECT revenue_rank AS rank, product_id, name, category, orders, units, revenue, margin
  FROM ({PRODUCTS}) ORDER BY revenue_rank, product_id LIMIT 10""")
O["report_customer_segments"] = with_star(f"""
  SELECT segment, count(*) AS customers, {AVG2.format(a='sum(revenue)', n='count(*)')}
         AS average_revenue, {money('revenue')}
  FROM segments GROUP BY segment ORDER BY revenue DESC""", segments())

O["measures_total"] = with_star(f"""
  ALSO total AS ({measured(SALES_SET, 'fact', [])}),
  shifted AS (SELECT DISTINCT day FROM moved),
  prev AS (SELECT CAST(sum(revenue) AS DOUBLE) AS p FROM sales JOIN shifted ON day = order_date),
  days AS (SELECT CAST(count(*) AS DOUBLE) AS d FROM cal)
  SELECT total.*, revenue / d AS daily_revenue, margin / d AS daily_margin,
         p AS revenue_previous_month,
         CAST(CAST(revenue AS DECIMAL(22,2)) - CAST(p AS DECIMAL(22,2)) AS DOUBLE) / p
           AS revenue_mom_pct,
         (SELECT count(*) FROM segments) AS customers
  FROM total, prev, days""", segments(), PREVIOUS)
O["measures_by_month"] = with_star(
    measured(SALES_SET, "fact JOIN cal m USING (date_key)", ["m.year_month"],
             f"{per_day('revenue', MONTH_DAYS)}, {per_day('margin', MONTH_DAYS)}"))
O["daily_by_month"] = with_star(
    measured([], "fact JOIN cal m USING (date_key)", ["m.year_month"],
             f"{per_day('revenue', MONTH_DAYS)}, {per_day('margin', MONTH_DAYS)}"))
O["measures_by_category"] = with_star(
    measured(SALES_SET, "fact JOIN good USING (product_id)", ["category"]))
O["measures_by_channel"] = with_star(
    measured(SALES_SET, "fact", ["channel"],
             per_day("revenue", "(SELECT CAST(count(*) AS DOUBLE) FROM cal)")))
O["measures_by_country"] = with_star(
    measured(SALES_SET, "fact JOIN person USING (customer_id)", ["country"]))
O["measures_by_weekday"] = with_star(
    measured(SALES_SET, "fact JOIN cal m USING (date_key)", ["m.day_of_week", "m.is_weekend"],
             per_day("revenue", "(SELECT CAST(count(*) AS DOUBLE) FROM cal c"
                                " WHERE c.day_of_week = m.day_of_week)")))
O["return_rate"] = with_star(
    measured(["return_rate"], "fact JOIN good USING (product_id)", ["category", "channel"]))
O["revenue_mom"] = with_star("""
  SELECT year_month, CAST(revenue AS DOUBLE) AS revenue,
         CAST(previous AS DOUBLE) AS revenue_previous_month,
         CAST(revenue - previous AS DOUBLE) / CAST(previous AS DOUBLE) AS revenue_mom_pct
  FROM now_rev FULL JOIN prev_rev USING (year_month)""", PREVIOUS)
O["revenue_previous_month_by_day"] = with_star(f"""
  SELECT full_date, CAST(r AS DOUBLE) AS revenue, CAST(p AS DOUBLE) AS revenue_previous_month
  FROM (SELECT order_date AS full_date, sum(revenue) FILTER ({SELL}) AS r FROM fact GROUP BY 1)
  FULL JOIN (
    SELECT c.full_date, sum(revenue) FILTER ({SELL}) AS p
    FROM cal c JOIN fact ON fact.order_date = CAST(c.full_date - INTERVAL 1 MONTH AS DATE)
    GROUP BY 1) USING (full_date)""")
O["revenue_by_segment"] = with_star(f"""
  SELECT f.segment, f.revenue, f.orders, c.customers
  FROM ({measured(['revenue', 'orders'], 'fact LEFT JOIN segments USING (customer_id)',
                  ['segment']).replace('revenue)', 'fact.revenue)')
        .replace('count(DISTINCT order_id)', 'count(DISTINCT fact.order_id)')}) f
  LEFT JOIN (SELECT segment, count(*) AS customers FROM segments GROUP BY segment) c
    ON c.segment = f.segment""", segments())
O["customers_by_country"] = with_star(
    "SELECT country, count(*) AS customers FROM segments GROUP BY country", segments())
O["measures_in_context"] = with_star(f"""
  ALSO best AS (SELECT customer_id, country FROM segments WHERE segment IN ('champion', 'loyal')),
  lines AS (
    SELECT fact.*, best.country FROM fact JOIN best USING (customer_id)
    JOIN good USING (product_id)
    WHERE category = 'PROMO' AND channel IN ('web', 'mobile') AND order_date >= DATE '1998-01-01'),
  people AS (SELECT country, count(*) AS customers FROM best GROUP BY country),
  sums AS ({measured(SALES_SET, 'lines', ['country'], per_day(
      'revenue', "(SELECT CAST(count(*) AS DOUBLE) FROM cal WHERE year >= 1998)"))})
  SELECT * FROM sums FULL JOIN people USING (country)""", segments())
O["revenue_by_status_filter"] = with_star(measured(["revenue", "orders"], "fact", ["channel"]))
O["cards"] = with_star(
    measured(["revenue", "margin_pct", "orders", "average_order_value"], "fact", []))
O["revenue_by_category"] = with_star(
    measured(["revenue"], "fact JOIN good USING (product_id)", ["category"]))
O["by_channel"] = with_star(measured(["revenue", "margin"], "fact", ["channel"]))
O["measures_product_table"] = with_star(
    measured(["units", "revenue", "margin_pct"], "fact JOIN good USING (product_id)",
             ["name", "category"]))
O["revenue_by_country"] = with_star(
    measured(["revenue"], "fact JOIN person USING (customer_id)", ["country"]))
O["customers_by_segment"] = with_star(
    "SELECT segment, count(*) AS customers FROM segments GROUP BY segment", segments())
O["slicer_values"] = with_star("""
  SELECT DISTINCT 'channel' AS slicer, channel AS value FROM fact
  UNION ALL SELECT DISTINCT 'country', country FROM person""")

O["dim_date"] = with_star("SELECT * EXCLUDE (year_month) FROM cal")
O["dim_customer"] = with_star("SELECT customer_key, customer_id, name, country FROM person")
O["dim_product"] = with_star("""
  SELECT product_key, product_id, name, category, CAST(unit_cost AS DOUBLE) AS unit_cost FROM good""")
FACT_OUT = """
  SELECT order_id, product_key, customer_key, date_key, status, channel,
         CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
         CAST(revenue AS DOUBLE) AS {p}revenue, CAST(cost AS DOUBLE) AS {p}cost,
         CAST(margin AS DOUBLE) AS {p}margin, order_date FROM fact"""
O["fact_order_items"] = with_star(FACT_OUT.format(p="line_"))
O["export_fact"] = O["export_reload"] = with_star(FACT_OUT.format(p=""))
O["export_reload_monthly"] = O["monthly_revenue"]
O["export_counts"] = with_star("""
  SELECT 'dim_date' AS table_name, count(*) AS rows FROM cal
  UNION ALL SELECT 'dim_customer', count(*) FROM person
  UNION ALL SELECT 'dim_product', count(*) FROM good
  UNION ALL SELECT 'fact_order_items', count(*) FROM fact""")
O["csv_snapshot"] = with_star("""
  SELECT customer_id, country, segment, recency_score, frequency_score, monetary_score
  FROM segments""", segments())

O["surrogate_keys"] = with_star("""
  ALSO early AS (SELECT DISTINCT customer_id FROM ord WHERE o_orderdate < DATE '1996-01-01'),
  old AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key
          FROM person JOIN early USING (customer_id)),
  fresh AS (SELECT customer_id, (SELECT max(customer_key) FROM old)
                   + row_number() OVER (ORDER BY customer_id) AS customer_key
            FROM person WHERE customer_id NOT IN (SELECT customer_id FROM old))
  SELECT k.customer_key, customer_id, name, country
  FROM (SELECT * FROM old UNION ALL SELECT * FROM fresh) k JOIN person USING (customer_id)""")
O["calendar_extension"] = with_star("""
  ALSO ship AS (
    SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d
    FROM (SELECT min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem)),
  days AS (SELECT full_date FROM cal UNION SELECT CAST(d AS DATE) FROM ship)
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month,
         CASE WHEN d IN (SELECT full_date FROM cal) THEN upper(monthname(d))
              ELSE monthname(d) END AS month_name,
         isodow(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
  FROM (SELECT full_date AS d FROM days)""")
O["vanished_lines"] = with_star("""
  SELECT order_id, product_id, CAST(quantity AS BIGINT) AS quantity,
         CAST(revenue AS DOUBLE) AS revenue
  FROM fact f WHERE NOT EXISTS (
    SELECT 1 FROM item i WHERE i.order_id = f.order_id AND i.product_id = f.product_id
     AND i.l_returnflag <> 'R')""")
O["orphan_facts"] = with_star("""
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_key, count(*) AS lines
  FROM item WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT full_date FROM cal) GROUP BY 1""")

O["distributed_ntile"] = """
  SELECT o_orderkey, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS price_tile,
         ntile(4) OVER (ORDER BY o_orderdate, o_orderkey) AS date_tile FROM orders"""
O["distributed_rank"] = """
  SELECT l_partkey, count(*) AS lines, rank() OVER (ORDER BY count(*) DESC) AS line_rank
  FROM lineitem GROUP BY l_partkey"""
O["distributed_index"] = """
  SELECT c_custkey, c_acctbal,
         row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS position FROM customer"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
O["shape_check"] = """
  SELECT '' AS errors, count(*) AS events FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 200)
  UNION ALL
  SELECT 'items: Array must contain at most 200 element(s)', count(*)
  FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
        GROUP BY l_orderkey HAVING count(*) > 200) HAVING count(*) > 0
  UNION ALL
  SELECT 'order_id: Required; customer_id: Required; status: Required; channel: Required; '
      || 'ordered_at: Required; items: Required; order: Unrecognized key(s) in object: '
      || '''k''', count(*) FROM events"""
O["order_value_rejections"] = """
  SELECT concat_ws('; ', CASE WHEN o_orderkey % 3 = 0 THEN 'unknown status lost' END,
           CASE WHEN o_orderkey % 5 = 0 THEN 'unknown channel (empty)' END,
           CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'ordered_at is not a valid timestamp' END,
           'item 1: not an object') AS reasons,
         CASE WHEN o_orderkey % 3 = 0 THEN 'lost' ELSE ' Placed ' END AS sent_status, count(*) AS orders
  FROM orders GROUP BY 1, 2"""
O["refused_events"] = """
  SELECT event_id AS position, 'order_id: Required; customer_id: Required; status: Required; channel: Required; '
      || 'ordered_at: Required; items: Required; order: Unrecognized key(s) in object: ''k''' AS errors,
    props AS text FROM events
  UNION ALL SELECT -o_orderkey, 'Body is not valid JSON', '{' || o_orderkey FROM orders"""
O["landing_latest"] = f"""
  SELECT CAST(user_id AS VARCHAR) AS order_id, arg_max(props, ts) AS doc,
         {STAMP.format('max(ts)')} AS ingested_at, {STAMP.format('min(ts)')} AS first_seen_at
  FROM events GROUP BY user_id"""
O["landing_batch"] = """
  SELECT CAST(user_id AS VARCHAR) AS order_id, arg_max(props, event_id) AS doc,
         '2024-02-01 00:00:00.000000' AS ingested_at, '2024-02-01 00:00:00.000000' AS first_seen_at
  FROM events GROUP BY user_id"""
SINCE = "ts > TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTE"
O["incremental_scan"] = f"""
  SELECT event_id, CAST(user_id AS VARCHAR) AS order_id, {STAMP.format('ts')} AS ingested_at
  FROM events WHERE {SINCE}"""
O["watermark_advance"] = f"""
  SELECT event_type, {STAMP.format('max(ts)')} AS position, count(*) AS read
  FROM events WHERE {SINCE} GROUP BY event_type"""

# Orders as sent, judged rule by rule in SQL.
JUDGED = f"""
sent AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_quantity, l_extendedprice, l_discount, l_tax) AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS size
  FROM item),
door AS (SELECT * FROM ord WHERE o_orderkey NOT IN (SELECT l_orderkey FROM sent WHERE size > 200)),
marked AS (
  SELECT s.*, p_size > 45 AS stranger,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY pos) > 1 AS again,
         l_discount = 0.1 AS fraction, l_tax = 0.08 AND unit_price > 0 AS negative
  FROM sent s JOIN good g ON g.product_key = s.l_partkey WHERE size <= 200),
line_rule AS (
  SELECT l_orderkey, pos, 1 AS rule, CASE WHEN stranger THEN 'unknown product ' || product_id
         ELSE 'product ' || product_id || ' listed twice' END AS reason
  FROM marked WHERE stranger OR again
  UNION ALL SELECT l_orderkey, pos, 2, 'quantity must be a positive integer'
  FROM marked WHERE fraction
  UNION ALL SELECT l_orderkey, pos, 3, 'unit_price must be a non-negative amount'
  FROM marked WHERE negative),
head_rule AS (
  SELECT o_orderkey AS l_orderkey, 0 AS pos, 1 AS rule, 'unknown customer ' || door.customer_id AS reason
  FROM door JOIN person USING (customer_id) WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT o_orderkey, 0, 2, 'ordered_at is in the future'
  FROM door WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'
  UNION ALL SELECT o_orderkey, 0, 3, 'an order needs at least one item'
  FROM door WHERE o_orderkey NOT IN (SELECT l_orderkey FROM item)),
all_rules AS (
  SELECT l_orderkey, pos, rule, reason AS plain, reason FROM head_rule
  UNION ALL
  SELECT l_orderkey, pos, rule, reason, 'item ' || pos || ': ' || reason FROM line_rule),
rejected AS (
  SELECT l_orderkey, CAST(l_orderkey AS VARCHAR) AS record_id, count(*) AS n,
         string_agg(reason, '; ' ORDER BY pos, rule) AS reasons
  FROM all_rules GROUP BY l_orderkey),
good_orders AS (SELECT * FROM door WHERE o_orderkey NOT IN (SELECT l_orderkey FROM rejected)),
good_lines AS (SELECT item.* FROM item JOIN good_orders g ON g.o_orderkey = item.l_orderkey),
good_fact AS (SELECT fact.* FROM fact JOIN good_orders USING (order_id)),
good_sales AS (SELECT * FROM good_fact WHERE status NOT IN ('cancelled', 'returned'))"""

O["order_validation_split"] = with_star("""
  SELECT order_id, n IS NULL AS valid, coalesce(n, 0) AS reasons
  FROM door LEFT JOIN rejected ON l_orderkey = o_orderkey""", JUDGED)
O["order_rejections"] = with_star(
    "SELECT 'orders' AS source, record_id, reasons FROM rejected", JUDGED)
O["order_rejection_reasons"] = with_star("""
  SELECT regexp_replace(plain, '[0-9]+', 'N', 'g') AS rule, count(*) AS times
  FROM all_rules GROUP BY 1""", JUDGED)
LINES_OUT = """
  SELECT order_id, product_id, CAST(quantity AS BIGINT) AS quantity,
         CAST(unit_price AS DOUBLE) AS unit_price FROM {}"""
O["accepted_order_lines"] = O["pipeline_replay"] = with_star(LINES_OUT.format("good_lines"), JUDGED)
O["stream_order_load"] = with_star(f"""
  SELECT order_id, customer_id, status, channel, {STAMP.format('o_orderdate')} AS ordered_at
  FROM good_orders""", JUDGED)
O["pipeline_monthly_revenue"] = with_star(MONTHLY.format(sales="good_sales"), JUDGED)
O["pipeline_fact"] = with_star("""
  SELECT order_id, product_id, customer_id, date_key, status, channel,
         CAST(quantity AS BIGINT) AS quantity, CAST(revenue AS DOUBLE) AS revenue,
         CAST(cost AS DOUBLE) AS cost, CAST(margin AS DOUBLE) AS margin FROM good_fact""", JUDGED)
O["pipeline_segments"] = with_star(SEGMENTS_OUT, JUDGED, segments("good_sales"))
O["rejections_by_source"] = with_star(
    "SELECT 'orders' AS source, count(*) AS records FROM rejected", JUDGED)
CHECK_ROWS = """
  SELECT 'fact_rows_match_staging' AS check_name, a.n = b.n AS passed,
         'staging=' || a.n || ' fact=' || b.n AS observed
  FROM (SELECT count(*) AS n FROM {items}) a, (SELECT count(*) AS n FROM {fact}) b
  UNION ALL
  SELECT 'revenue_reconciles_with_staging', a.n = b.n, 'staging=' || a.n || ' fact=' || b.n
  FROM (SELECT sum(quantity * unit_price) AS n FROM {items}) a,
       (SELECT sum(revenue) AS n FROM {fact}) b
  UNION ALL SELECT 'no_non_positive_quantity', count(*) = 0, count(*) || ' rows'
  FROM {fact} WHERE quantity <= 0
  UNION ALL SELECT 'customer_business_keys_unique', count(*) = count(DISTINCT customer_id),
         count(*) || ' rows, ' || count(DISTINCT customer_id) || ' distinct' FROM {people}
  UNION ALL SELECT 'every_fact_has_a_calendar_day', count(*) = 0, count(*) || ' orphan rows'
  FROM {fact} WHERE date_key NOT IN (SELECT date_key FROM cal)
  UNION ALL SELECT 'margin_is_revenue_minus_cost', count(*) = 0, count(*) || ' rows'
  FROM {fact} WHERE margin <> revenue - cost"""
O["quality_checks"] = with_star(CHECK_ROWS.format(items="item", fact="fact", people="person"))
O["pipeline_quality"] = with_star(
    CHECK_ROWS.format(items="good_lines", fact="good_fact", people="known"), JUDGED,
    "known AS (SELECT * FROM person WHERE c_mktsegment <> 'MACHINERY')")


def _unique(table: str, key: str, source: str) -> str:
    return f"""
  SELECT 'unique_{table}_{key.replace(', ', '_')}' AS check_name, sum(n) = count(*) AS passed,
         sum(n) || ' rows, ' || count(*) || ' distinct' AS observed
  FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"""


def _none(name: str, source: str, what: str, where: str) -> str:
    return f"""
  SELECT '{name}', count(*) = 0, count(*) || ' {what}' FROM {source} WHERE {where}"""


O["constraint_checks"] = with_star(" UNION ALL ".join([
    _unique("orders", "order_id", "ord"),
    _unique("order_items", "order_id, product_id", "item"),
    _unique("dim_date", "date_key", "cal"),
    _unique("dim_date", "full_date", "cal"),
    _unique("dim_customer", "customer_key", "person"),
    _unique("dim_product", "product_id", "good"),
    _unique("fact_order_items", "order_id, product_key", "fact"),
    _none("foreign_key_order_items_order_id", "item", "orphan rows",
          "order_id NOT IN (SELECT order_id FROM ord)"),
    _none("foreign_key_fact_order_items_product_key", "fact", "orphan rows",
          "product_key NOT IN (SELECT product_key FROM good)"),
    _none("foreign_key_fact_order_items_customer_key", "fact", "orphan rows",
          "customer_key NOT IN (SELECT customer_key FROM person)"),
    _none("foreign_key_fact_order_items_date_key", "fact", "orphan rows",
          "date_key NOT IN (SELECT date_key FROM cal)"),
    _none("not_null_dim_date", "cal", "rows", "date_key IS NULL OR full_date IS NULL"),
    _none("not_null_fact_order_items", "fact", "rows",
          "order_id IS NULL OR revenue IS NULL OR margin IS NULL OR cost IS NULL"),
    _none("not_null_order_items", "item", "rows", "order_id IS NULL OR unit_price IS NULL"),
]))

O["duplicate_items"] = with_star("""
  SELECT order_id, product_id, count(*) AS copies FROM item GROUP BY ALL HAVING count(*) > 1""")
O["orders_without_items"] = with_star(f"""
  SELECT order_id, status, {STAMP.format('o_orderdate')} AS ordered_at
  FROM ord WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
O["known_customer_check"] = with_star("""
  SELECT DISTINCT customer_id FROM ord
  WHERE customer_id NOT IN (SELECT customer_id FROM person WHERE c_mktsegment <> 'MACHINERY')""")

O["customer_validation"] = """
  WITH raw AS (
    SELECT 'C' || c_custkey AS record_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS name,
           'user' || c_custkey || CASE WHEN c_acctbal < 0 THEN '' ELSE '@' END || 'example.com'
             AS email,
           c_nationkey > 0 AS has_country,
           TRY_CAST('1996-' || lpad(CAST(c_nationkey % 14 AS VARCHAR), 2, '0') || '-'
                    || lpad(CAST(c_custkey % 33 AS VARCHAR), 2, '0') AS DATE) AS signup_date
    FROM customer)
  SELECT record_id, name, email, signup_date,
         concat_ws('; ', CASE WHEN name = '' THEN 'name is required' END,
                   CASE WHEN NOT contains(email, '@') THEN 'email is not valid' END,
                   CASE WHEN NOT has_country THEN 'country is required' END,
                   CASE WHEN signup_date IS NULL THEN 'signup_date must be YYYY-MM-DD' END)
           AS reasons
  FROM raw"""
O["product_validation"] = """
  WITH raw AS (
    SELECT CAST(p_partkey AS VARCHAR) AS record_id, p_size, p_type,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
  cost AS (
    SELECT *, CAST(CASE WHEN p_size <= 40 OR p_size = 47 THEN price
                        WHEN p_size = 50 THEN price * 10 END AS DOUBLE) AS unit_cost FROM raw)
  SELECT record_id, unit_cost, CAST(price AS DOUBLE) AS list_price,
         concat_ws('; ', CASE WHEN p_type = 'PROMO' THEN 'category is required' END,
                   CASE WHEN unit_cost IS NULL
                        THEN 'unit_cost must be a non-negative amount' END) AS reasons
  FROM cost"""

O["upsert_orders"] = with_star(f"""
  SELECT order_id, customer_id, status, channel, {STAMP.format('o_orderdate')} AS ordered_at
  FROM ord""")
O["replace_children"] = with_star("""
  SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(max(unit_price) AS DOUBLE) AS unit_price
  FROM item JOIN ord USING (order_id) WHERE channel = 'web' GROUP BY order_id, product_id
  UNION ALL
  SELECT order_id, product_id, CAST(quantity AS BIGINT), CAST(unit_price AS DOUBLE)
  FROM item JOIN ord USING (order_id) WHERE channel <> 'web'""")
O["latest_check_result"] = f"""
  SELECT event_type AS check_name, value < 50 AS passed, CAST(event_id AS VARCHAR) AS observed,
         {STAMP.format('ts')} AS checked_at
  FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1"""
O["last_row_wins"] = """
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderkey, o_orderstatus
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
O["rejections_after_correction"] = with_star("""
  SELECT 'orders' AS source, order_id AS record_id,
         CASE WHEN channel = 'web' THEN 'unknown channel web' ELSE 'unknown status ' || status END
           AS reasons,
         CASE WHEN channel = 'web' THEN '2001-01-02' ELSE '2001-01-01' END
           || ' 00:00:00.000000' AS rejected_at
  FROM ord WHERE (channel = 'web' AND status <> 'placed')
     OR (channel = 'mobile' AND status IN ('cancelled', 'returned'))""")

KNOWN = "known AS (SELECT * FROM person WHERE c_mktsegment <> 'MACHINERY')"
SOLD = "sold AS (SELECT * FROM good WHERE p_size <= 45)"
DAYS = "days AS (SELECT date_diff('day', min(order_date), max(order_date)) + 1 AS n FROM good_orders)"
REFUSED = "(SELECT count(*) AS n FROM rejected)"
O["pipeline_status"] = with_star(
    "SELECT 'orders_loaded_up_to' AS part, 'orders' AS name, CAST(NULL AS BOOLEAN) AS passed, "
    "'2001-01-01 00:00:00' AS value UNION ALL "
    f"SELECT 'rejected', 'orders', NULL, CAST(n AS VARCHAR) FROM {REFUSED} UNION ALL "
    "SELECT 'checks', check_name, passed, observed FROM ("
    + CHECK_ROWS.format(items="good_lines", fact="good_fact", people="known") + ")", JUDGED, KNOWN)
O["quality_gate"] = with_star("""
  SELECT check_name, NOT passed AS stops, observed FROM (""" + CHECK_ROWS.format(
    items="item", fact="hurt", people="person") + ")", """
hurt AS (SELECT * REPLACE (CASE WHEN order_id LIKE '%7' THEN -quantity ELSE quantity END AS quantity,
                           CASE WHEN order_id LIKE '%3' THEN 99991231 ELSE date_key END AS date_key) FROM fact)""")
O["loaded_days"] = with_star(FACT_OUT.format(p="").replace("CAST(revenue AS DOUBLE)", "CAST(revenue * CASE WHEN year(order_date) = 1995 THEN 2 ELSE 1 END AS DOUBLE)")
                             + " WHERE order_date BETWEEN DATE '1994-12-01' AND DATE '1995-01-31'")


def _counts(rows: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {names}, {n} AS n" for names, n in rows.items())


LOADED = {  # rows of every table after a whole run
    "customers": "(SELECT count(*) FROM known)", "products": "(SELECT count(*) FROM sold)",
    "orders": "(SELECT count(*) FROM good_orders)", "order_items": "(SELECT count(*) FROM good_lines)",
    "dim_date": "(SELECT n FROM days)", "dim_customer": "(SELECT count(*) FROM known)",
    "dim_product": "(SELECT count(*) FROM sold)", "fact_order_items": "(SELECT count(*) FROM good_fact)",
    "landing": "(SELECT count(*) FROM door)", "refused_events": "0", "watermarks": "1", "quality_results": "6",
    "rejected_records": "(SELECT count(*) FROM rejected)", "loaded_dim_date": "0", "loaded_dim_customer": "0",
    "loaded_dim_product": "0", "loaded_fact_order_items": "0",
}
O["initial_tables"] = with_star("SELECT table_name, begins_empty, n AS rows FROM (" + _counts(
    {f"'{t}' AS table_name, true AS begins_empty": n for t, n in LOADED.items()}) + ")", JUDGED, KNOWN, SOLD, DAYS)
O["run_report"] = with_star("SELECT step, counted, n FROM (" + _counts({
    f"'{step}' AS step, '{name}' AS counted": n for step, name, n in (
        ("load_reference", "customers", LOADED["customers"]), ("load_reference", "products", LOADED["products"]),
        ("load_reference", "rejected", "0"), ("load_orders", "read", LOADED["landing"]),
        ("load_orders", "loaded", LOADED["orders"]), ("load_orders", "rejected", LOADED["rejected_records"]),
        ("compact_rejections", "parts", "2"), ("build_warehouse", "fact_rows", LOADED["fact_order_items"]),
        ("build_warehouse", "parts_rebuilt", "(SELECT count(DISTINCT date_trunc('month', order_date)) FROM good_orders)"),
        ("check_quality", "checks", "6"), ("refresh_marts", "marts", "4"))}) + ")", JUDGED, KNOWN, SOLD)
NOT_NULL = {  # the columns that the contract declares as not null
    "customers": "customer_id name email country signup_date loaded_at",
    "products": "product_id name category unit_cost list_price loaded_at",
    "orders": "order_id customer_id status channel ordered_at loaded_at order_date",
    "order_items": "order_id product_id quantity unit_price order_date",
    "dim_date": "date_key full_date year quarter month month_name day_of_week is_weekend",
    "dim_customer": "customer_key customer_id name email country signup_date",
    "dim_product": "product_key product_id name category unit_cost list_price",
    "fact_order_items": "order_id product_key customer_key date_key status channel quantity unit_price revenue cost "
                        "margin order_date",
    "watermarks": "source position updated_at",
    "rejected_records": "source record_id reasons payload rejected_at",
    "quality_results": "check_name passed observed checked_at",
}
KEYS = {
    "customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_id_product_id",
    "dim_date": "date_key full_date", "dim_customer": "customer_key customer_id",
    "dim_product": "product_key product_id", "fact_order_items": "order_id_product_key", "watermarks": "source",
    "rejected_records": "source_record_id",
}
O["declared_constraints"] = with_star(
    "SELECT name AS check_name, true AS passed, seen AS observed FROM (" + " UNION ALL ".join([
        *[f"SELECT 'not_null_{t}_{c}' AS name, '0 rows' AS seen" for t, cs in NOT_NULL.items() for c in cs.split()],
        *[f"SELECT 'unique_{t}_{k}', {LOADED[t]} || ' rows, ' || {LOADED[t]} || ' distinct'"
          for t, ks in KEYS.items() for k in ks.split()],
        *[f"SELECT 'foreign_key_{x}', '0 orphan rows'" for x in (
            "order_items_order_id", "fact_order_items_product_key", "fact_order_items_customer_key",
            "fact_order_items_date_key")],
    ]) + ")", JUDGED, KNOWN, SOLD, DAYS)
O["snapshot_contract"] = with_star("""
  SELECT 'dim_date' AS table_name, count(*) AS rows, 'dim_date: column is_weekend is missing' AS missing FROM cal
  UNION ALL SELECT 'dim_customer', count(*), '' FROM person
  UNION ALL SELECT 'dim_product', 0, 'dim_product: missing'
  UNION ALL SELECT 'fact_order_items', count(*), '' FROM fact
  UNION ALL SELECT 'customer_segments', count(*), '' FROM segments""", segments())
O["missing_target"] = O["export_counts"].replace("SELECT 'dim_date' AS table_name", "SELECT *, 'a target path must be set to export; a target path must be set to export' AS refused FROM (SELECT 'dim_date' AS table_name") + ")"
