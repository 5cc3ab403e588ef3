"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written against the raw fixture tables only, so each statement re-derives the
adapters, dedup, first load, dimensions and fact on its own; nothing here is
generated from the Spark code path. Shared pieces are plain CTE text.
"""

from __future__ import annotations

from strata.schemas import FIXTURE_ENTITIES
from strata.sources.fixtures import FIXTURE_BATCH_TS, FIXTURE_CALENDAR, SHORT_CALENDAR

TS = f"TIMESTAMP '{FIXTURE_BATCH_TS}'"


def msum(x: str) -> str:
    """Sum of the full amounts as decimals; text is how a decimal becomes the nearest double."""
    return f"CAST(CAST(SUM({dec(x)}) AS VARCHAR) AS DOUBLE)"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28, 8))"


def date_id(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


def items_cte(name: str, where: str = "") -> str:
    return f"""{name} AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_total,
         l_shipdate AS created_at, l_shipdate AS updated_at, l_returnflag = 'R' AS is_deleted,
         {TS} AS _extracted_at, 'order_items' AS _source_table
  FROM lineitem {where})"""


B_ITEMS = items_cte("b_items")

B_ORDERS = f"""b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancelled'
              WHEN o_orderstatus = 'F' THEN 'delivered'
              WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'pending' END AS order_status,
         o_orderdate AS order_ts, o_totalprice AS total_amount,
         CAST(NULL AS VARCHAR) AS shipping_city, o_orderdate AS created_at,
         o_orderdate AS updated_at,
         (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS is_deleted,
         {TS} AS _extracted_at, 'orders' AS _source_table
  FROM orders)"""

B_PRODUCTS = f"""b_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS subcategory,
         p_retailprice AS unit_price, p_retailprice AS cost_price, {TS} AS created_at,
         {TS} AS updated_at, (p_size % 10) = 0 AS is_deleted, {TS} AS _extracted_at,
         'products' AS _source_table
  FROM part)"""

B_CUSTOMERS = f"""b_customers AS (
  SELECT c.c_custkey AS customer_id, split_part(c.c_name, '#', 1) AS first_name,
         split_part(c.c_name, '#', 2) AS last_name,
         lower(replace(c.c_name, '#', '.')) || '@example.com' AS email,
         g.n_name AS city, g.r_name AS country, c.c_mktsegment AS segment,
         {TS} AS created_at, {TS} AS updated_at, c.c_acctbal < 0 AS is_deleted,
         {TS} AS _extracted_at, 'customers' AS _source_table
  FROM customer c
  LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
    ON c.c_nationkey = g.n_nationkey)"""

BRONZE = ",\n".join([B_ITEMS, B_ORDERS, B_PRODUCTS, B_CUSTOMERS])


def latest(src: str, keys: str, extra_order: str = "") -> str:
    order = "updated_at DESC NULLS LAST, _extracted_at DESC NULLS LAST" + extra_order
    return (f"SELECT * FROM {src} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1")


ITEM_ORDER = ", product_id DESC NULLS LAST, supplier_id DESC NULLS LAST"

# dedup, then the first-load insert rule: only rows whose delete flag is false enter
SILVER = f"""d_items AS ({latest('b_items', 'order_id, line_number', ITEM_ORDER)}),
d_orders AS ({latest('b_orders', 'order_id')}),
d_products AS ({latest('b_products', 'product_id')}),
d_customers AS ({latest('b_customers', 'customer_id')}),
s_items AS (SELECT * FROM d_items WHERE is_deleted = false),
s_orders AS (SELECT * FROM d_orders WHERE is_deleted = false),
s_products AS (SELECT * FROM d_products WHERE is_deleted = false),
s_customers AS (SELECT * FROM d_customers WHERE is_deleted = false)"""


def date_columns_sql(days_from: str) -> str:
    d = "d"
    return f"""SELECT {date_id(d)} AS date_id, {d} AS full_date,
       CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter,
       CAST(month({d}) AS INTEGER) AS month, monthname({d}) AS month_name,
       CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
       CAST(day({d}) AS INTEGER) AS day_of_month,
       CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week, dayname({d}) AS day_name,
       dayofweek({d}) IN (0, 6) AS is_weekend, {d} = last_day({d}) AS is_month_end
FROM {days_from}"""


def dim_date_sql(start: str, end: str) -> str:
    return date_columns_sql(f"""(SELECT CAST(range AS DATE) AS d
      FROM range(DATE '{start}', DATE '{end}' + INTERVAL 1 DAY, INTERVAL 1 DAY))""")


GOLD = f"""dim_date AS ({dim_date_sql(*FIXTURE_CALENDAR)}),
dim_customer AS (
  SELECT customer_id, first_name, last_name, email, segment, city, country,
         NOT is_deleted AS is_active, created_at, updated_at FROM s_customers),
dim_product AS (
  SELECT product_id, name, category, subcategory, unit_price, cost_price,
         NOT is_deleted AS is_active, created_at, updated_at FROM s_products),
fact AS (
  SELECT i.order_id, i.line_number, {date_id('o.order_ts')} AS date_id, o.customer_id,
         i.product_id, o.order_status, o.shipping_city, i.quantity, i.unit_price,
         i.line_total, p.cost_price, round(i.line_total - i.quantity * p.cost_price, 2)
         AS gross_margin, o.order_ts, i._extracted_at
  FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
  LEFT JOIN s_products p ON i.product_id = p.product_id
  WHERE NOT i.is_deleted AND NOT o.is_deleted)"""


def with_star(body: str) -> str:
    return f"WITH {BRONZE},\n{SILVER},\n{GOLD}\n{body}"


def per_order(keys: str) -> str:
    """Order lines added up per order first, for the views: another way to the same figures."""
    return (f"o AS (SELECT order_id, {keys}, SUM({dec('line_total')}) AS r, "
            f"SUM({dec('gross_margin')}) AS g, SUM(quantity) AS q FROM fact GROUP BY ALL)")


def dbl(x: str) -> str:
    return f"CAST(CAST(SUM({x}) AS VARCHAR) AS DOUBLE)"


VIEWS = {
    "kpi_segment_month_view": (per_order("customer_id, date_id"), f"""
SELECT year, month, segment, {dbl('r')} AS revenue, {dbl('g')} AS gross_margin,
       COUNT(DISTINCT order_id) AS orders
FROM o JOIN (SELECT date_id, year, month FROM dim_date) USING (date_id)
JOIN (SELECT customer_id, segment FROM dim_customer) USING (customer_id) GROUP BY ALL"""),
    "kpi_top_products_view": (per_order("product_id"), f"""
SELECT p.product_id, name, category, subcategory, units_sold, revenue, gross_margin
FROM dim_product p JOIN (SELECT product_id, CAST(SUM(q) AS BIGINT) AS units_sold, {dbl('r')} AS revenue,
  {dbl('g')} AS gross_margin FROM o GROUP BY product_id) USING (product_id)"""),
    "kpi_status_funnel_view": (per_order("order_status"), f"""
SELECT order_status, COUNT(*) AS orders, {dbl('r')} AS revenue FROM o GROUP BY order_status"""),
    "kpi_customer_ltv_view": (per_order("customer_id"), f"""
SELECT c.customer_id, first_name, last_name, segment, total_orders, lifetime_revenue, lifetime_margin
FROM dim_customer c JOIN (SELECT customer_id, COUNT(*) AS total_orders, {dbl('r')} AS lifetime_revenue,
  {dbl('g')} AS lifetime_margin FROM o GROUP BY customer_id) USING (customer_id)"""),
    "kpi_daily_view": (per_order("customer_id, date_id"), f"""
SELECT full_date, COUNT(*) AS orders, len(list(DISTINCT customer_id)) AS active_customers,
       {dbl('r')} AS revenue, {dbl('g')} AS gross_margin, CAST(SUM(q) AS BIGINT) AS units
FROM o JOIN dim_date USING (date_id) GROUP BY full_date"""),
}


K1 = f"""SELECT d.year, d.month, c.segment, {msum('f.line_total')} AS revenue,
       {msum('f.gross_margin')} AS gross_margin, COUNT(DISTINCT f.order_id) AS orders
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
JOIN dim_date d ON f.date_id = d.date_id
GROUP BY d.year, d.month, c.segment"""

K2 = f"""SELECT p.product_id, p.name, p.category, p.subcategory,
       CAST(SUM(f.quantity) AS BIGINT) AS units_sold, {msum('f.line_total')} AS revenue,
       {msum('f.gross_margin')} AS gross_margin
FROM fact f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category, p.subcategory"""

K3 = f"""SELECT order_status, COUNT(DISTINCT order_id) AS orders,
       {msum('line_total')} AS revenue
FROM fact GROUP BY order_status"""

K4 = f"""SELECT c.customer_id, c.first_name, c.last_name, c.segment,
       COUNT(DISTINCT f.order_id) AS total_orders, {msum('f.line_total')} AS lifetime_revenue,
       {msum('f.gross_margin')} AS lifetime_margin
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
GROUP BY c.customer_id, c.first_name, c.last_name, c.segment"""

K5 = f"""SELECT d.full_date, COUNT(DISTINCT f.order_id) AS orders,
       COUNT(DISTINCT f.customer_id) AS active_customers, {msum('f.line_total')} AS revenue,
       {msum('f.gross_margin')} AS gross_margin, CAST(SUM(f.quantity) AS BIGINT) AS units
FROM fact f JOIN dim_date d ON f.date_id = d.date_id
GROUP BY d.full_date"""

QUERIES: dict[str, str] = {
    "kpi_segment_month": with_star(K1),
    **{n: f"WITH {BRONZE},\n{SILVER},\n{GOLD},\n{cte}\n{body}" for n, (cte, body) in VIEWS.items()},
    "kpi_top_products": with_star(K2),
    "kpi_status_funnel": with_star(K3),
    "kpi_customer_ltv": with_star(K4),
    "kpi_daily": with_star(K5),
    "top_segment_months": with_star(
        f"SELECT * FROM ({K1}) ORDER BY revenue DESC NULLS LAST, year, month, segment LIMIT 10"),
    "top_products": with_star(
        f"SELECT * FROM ({K2}) ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10"),
    "top_customers": with_star(
        f"SELECT * FROM ({K4}) ORDER BY lifetime_revenue DESC NULLS LAST, customer_id LIMIT 10"),
    "last_30_days": with_star(f"SELECT * FROM ({K5}) ORDER BY full_date DESC LIMIT 30"),
    "dim_customer": with_star("SELECT * FROM dim_customer"),
    "dim_product": with_star("SELECT * FROM dim_product"),
    "fact_order_line": with_star("SELECT * FROM fact"),
}


# --- calendar, dedup, merges, projections ----------------------------------------------

ITEM_COLS = FIXTURE_ENTITIES["order_items"].columns
ORDER_COLS = FIXTURE_ENTITIES["orders"].columns
ENTITY_ORDER = ("customers", "products", "orders", "order_items")
BRONZE_CTE = {"customers": "b_customers", "products": "b_products", "orders": "b_orders",
              "order_items": "b_items"}
SILVER_CTE = {"customers": "s_customers", "products": "s_products", "orders": "s_orders",
              "order_items": "s_items"}

DIM_DATE_SPAN = date_columns_sql("""(
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
        FROM orders))""")

FIRST = latest("b_first", "order_id, line_number", ITEM_ORDER)
SECOND = latest("b_second", "order_id, line_number", ITEM_ORDER)
BATCHES = ",\n".join([items_cte("b_first", "WHERE l_linestatus = 'F'"),
                      items_cte("b_second", "WHERE l_linestatus = 'O'")])


def merge_sql(target: str, source: str, update: str, insert: str) -> str:
    """Full-outer-join MERGE: a row per key picked from source or target."""
    take = (f"((t._p IS NOT NULL AND s._p IS NOT NULL AND coalesce({update}, false)) OR "
            f"(t._p IS NULL AND s._p IS NOT NULL AND coalesce({insert}, false)))")
    cols = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in ITEM_COLS)
    return f"""WITH {BATCHES},
t AS (SELECT *, 1 AS _p FROM ({target})),
s AS (SELECT *, 1 AS _p FROM ({source}))
SELECT {cols}
FROM t FULL OUTER JOIN s ON t.order_id = s.order_id AND t.line_number = s.line_number
WHERE {take} OR t._p IS NOT NULL"""


NEWER = "s.updated_at > t.updated_at"
ACTIVE = "s.is_deleted = false"
EPOCH_TS = "TIMESTAMP '1970-01-01 00:00:00'"
REG = ("(SELECT * FROM (VALUES ('customers'), ('products'), ('orders'), ('order_items')) "
       "v(table_name))")


def _u(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _q(name: str) -> str:
    return f"'{name}'"


def pk_nulls_sql() -> str:
    return f"WITH {BRONZE}\n{pk_nulls_body(BRONZE_CTE)}"


def pk_nulls_body(cte: dict[str, str]) -> str:
    return _u([f"SELECT {_q(n)} AS table_name, 'nulls' AS \"check\", {_q(k)} AS \"column\", "
               f"COUNT(*) FILTER (WHERE {k} IS NULL) AS n FROM {cte[n]}"
               for n in ENTITY_ORDER for k in FIXTURE_ENTITIES[n].keys])


def _dups(table: str, cte: str, keys) -> str:
    k = ", ".join(keys)
    return (f"SELECT {_q(table)} AS table_name, 'duplicate_keys' AS \"check\", "
            f"{_q(','.join(keys))} AS \"column\", "
            f"(SELECT COUNT(*) FROM (SELECT {k} FROM {cte} GROUP BY {k} HAVING COUNT(*) > 1))"
            f" AS n")


def duplicate_keys_sql() -> str:
    return f"WITH {BRONZE}\n" + _u(_dups(n, BRONZE_CTE[n], FIXTURE_ENTITIES[n].keys)
                                   for n in ENTITY_ORDER)


def silver_quality_sql() -> str:
    parts = []
    for n in ENTITY_ORDER:
        e, cte = FIXTURE_ENTITIES[n], SILVER_CTE[n]
        for c in e.required:
            parts.append(f"SELECT {_q(n)}, 'nulls', {_q(c)}, COUNT(*) FILTER (WHERE {c} IS NULL)"
                         f" FROM {cte}")
        parts.append(f"SELECT {_q(n)}, 'rows', NULL, COUNT(*) FROM {cte}")
        parts.append(f"SELECT {_q(n)}, 'active', NULL, COUNT(*) FILTER (WHERE NOT is_deleted "
                     f"OR is_deleted IS NULL) FROM {cte}")
        parts.append(f"SELECT {_q(n)}, 'deleted', NULL, COUNT(*) FILTER (WHERE is_deleted) "
                     f"FROM {cte}")
        parts.append(_dups(n, cte, e.keys))
    body = _u(parts)
    return with_star(f"SELECT * FROM ({body}) x(table_name, \"check\", \"column\", n)")


GOLD_KEYS = {"dim_date": ("date_id",), "dim_customer": ("customer_id",),
             "dim_product": ("product_id",), "fact_order_line": ("order_id", "line_number")}
GOLD_CTE = {"dim_date": "dim_date", "dim_customer": "dim_customer",
            "dim_product": "dim_product", "fact_order_line": "fact"}


def gold_quality_sql() -> str:
    parts = []
    for t, keys in GOLD_KEYS.items():
        cte = GOLD_CTE[t]
        for k in keys:
            parts.append(f"SELECT {_q(t)}, 'nulls', {_q(k)}, COUNT(*) FILTER (WHERE {k} IS NULL)"
                         f" FROM {cte}")
        parts.append(f"SELECT {_q(t)}, 'rows', NULL, COUNT(*) FROM {cte}")
        parts.append(_dups(t, cte, keys))
    return with_star(f"SELECT * FROM ({_u(parts)}) x(table_name, \"check\", \"column\", n)")


def constraints_sql() -> str:
    parts = []
    for n in ENTITY_ORDER:
        e, cte = FIXTURE_ENTITIES[n], SILVER_CTE[n]
        for c in e.required:
            parts.append(f"SELECT {_q(n)}, 'not_null', {_q(c)}, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) FROM {cte}")
        for r in e.constraints:
            parts.append(f"SELECT {_q(n)}, {_q(r.name)}, {_q(r.column)}, "
                         f"COUNT(*) FILTER (WHERE NOT ({r.expr})) FROM {cte}")
        if n == "customers":
            parts.append(f"SELECT 'customers', 'unique', 'email', coalesce((SELECT SUM(c) FROM "
                         f"(SELECT COUNT(*) AS c FROM {cte} WHERE email IS NOT NULL GROUP BY "
                         f"email HAVING COUNT(*) > 1)), 0)")
    return with_star(f"SELECT table_name, \"check\", \"column\", CAST(n AS BIGINT) AS n FROM "
                     f"({_u(parts)}) x(table_name, \"check\", \"column\", n)")


def freshness_sql(as_of: str, max_hours: float) -> str:
    a = f"TIMESTAMP '{as_of}'"
    parts = [f"""SELECT {_q(n)} AS table_name, latest, {a} AS as_of,
  (epoch_us({a}) - epoch_us(latest)) / 3.6e9 AS lag_hours,
  coalesce((epoch_us({a}) - epoch_us(latest)) / 3.6e9 <= {max_hours}, false) AS is_fresh
FROM (SELECT max(updated_at) AS latest FROM {SILVER_CTE[n]})""" for n in ENTITY_ORDER]
    return with_star(_u(parts))


FACT_TYPES = {"order_id": "bigint", "line_number": "int", "date_id": "int",
              "customer_id": "bigint", "product_id": "bigint", "order_status": "string",
              "shipping_city": "string", "quantity": "bigint", "unit_price": "double",
              "line_total": "double", "cost_price": "double", "gross_margin": "double",
              "order_ts": "timestamp_ntz", "_extracted_at": "timestamp_ntz"}


def profile_sql() -> str:
    parts = [f"""SELECT {_q(c)} AS column_name, {_q(t)} AS data_type, COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, COUNT(DISTINCT {c}) AS distinct_values,
  CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM fact"""
             for c, t in FACT_TYPES.items()]
    return with_star(_u(parts))


FK_SQL = with_star(_u([
    "SELECT 'customer_fk' AS rule_name, COUNT(*) AS orphans FROM fact f WHERE NOT EXISTS "
    "(SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id)",
    "SELECT 'product_fk', COUNT(*) FROM fact f WHERE NOT EXISTS "
    "(SELECT 1 FROM dim_product d WHERE d.product_id = f.product_id)",
    "SELECT 'date_fk', COUNT(*) FROM fact f WHERE NOT EXISTS "
    "(SELECT 1 FROM dim_date d WHERE d.date_id = f.date_id)"]))

QUERIES.update({
    "dim_date": DIM_DATE_SPAN,
    "dedup_latest": f"WITH {B_ITEMS}\n{latest('b_items', 'order_id, line_number', ITEM_ORDER)}",
    "merge_newer_wins": merge_sql(FIRST, SECOND, NEWER, ACTIVE),
    "merge_newer_wins_small_batch": merge_sql(FIRST, SECOND, NEWER, ACTIVE),
    "merge_scd1": merge_sql(FIRST, SECOND, "true", "true"),
    "stream_upsert": merge_sql(f"SELECT * FROM ({FIRST}) WHERE is_deleted = false", SECOND,
                               NEWER, ACTIVE),
    "cast_boolean": f"WITH {B_ORDERS}\nSELECT * FROM b_orders",
    "normalize_timestamps": f"WITH {B_ORDERS}\nSELECT * FROM b_orders",
    "incremental_extract": f"WITH {B_ORDERS}\nSELECT * FROM b_orders "
                           f"WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'",
    "full_reload": f"WITH {B_ORDERS}\nSELECT * FROM b_orders",
    "lineage_stamp": f"SELECT *, {TS} AS _extracted_at, 'events' AS _source_table FROM events",
    "watermark_state": f"""WITH {BRONZE},
saved AS (SELECT 'orders' AS table_name, max(updated_at) AS high_water_mark FROM b_orders
          UNION ALL SELECT 'order_items', max(updated_at) FROM b_items)
SELECT r.table_name, coalesce(saved.high_water_mark, {EPOCH_TS}) AS high_water_mark
FROM {REG} r LEFT JOIN saved ON r.table_name = saved.table_name""",
    "watermark_advance": f"""WITH {BRONZE},
prior AS (SELECT r.table_name, coalesce(p.m, {EPOCH_TS}) AS m FROM {REG} r LEFT JOIN
  (SELECT * FROM (VALUES ('orders', TIMESTAMP '2000-01-01 00:00:00'),
                         ('order_items', TIMESTAMP '2001-01-01 00:00:00'),
                         ('products', {TS})) v(table_name, m)) p
  ON r.table_name = p.table_name),
marks AS (
  SELECT 'customers' AS table_name, max(updated_at) AS bm FROM b_customers
    WHERE updated_at > (SELECT m FROM prior WHERE table_name = 'customers')
  UNION ALL SELECT 'products', max(updated_at) FROM b_products
    WHERE updated_at > (SELECT m FROM prior WHERE table_name = 'products')
  UNION ALL SELECT 'orders', max(updated_at) FROM b_orders
    WHERE updated_at > (SELECT m FROM prior WHERE table_name = 'orders')
  UNION ALL SELECT 'order_items', max(updated_at) FROM b_items
    WHERE updated_at > (SELECT m FROM prior WHERE table_name = 'order_items'))
SELECT prior.table_name, coalesce(marks.bm, prior.m) AS high_water_mark
FROM prior LEFT JOIN marks ON prior.table_name = marks.table_name""",
    "ingest_json_events": "SELECT * FROM events",
    "events_latest": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, "
                     "event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1",
    "direct_file_scan": f"SELECT event_type, COUNT(*) AS n, {msum('value')} AS total_value "
                        f"FROM events GROUP BY event_type",
    "append_history": "SELECT * FROM events",
    "reconcile_counts": "SELECT 'events' AS table_name, COUNT(*) AS source_rows, "
                        "COUNT(*) AS table_rows, 'OK' AS status, true AS exact FROM events",
    "stream_file_once": "SELECT * FROM events",
    "pk_nulls": pk_nulls_sql(),
    "duplicate_keys": duplicate_keys_sql(),
    "silver_quality": silver_quality_sql(),
    "gold_quality": gold_quality_sql(),
    "fk_orphans": FK_SQL,
    "metric_sanity": with_star("SELECT COUNT(*) FILTER (WHERE quantity < 0 OR unit_price < 0 "
                               "OR line_total < 0) AS negative_rows FROM fact"),
    "check_constraints": constraints_sql(),
    "freshness": freshness_sql("2024-06-02 00:00:00", 24.0),
    "profile_columns": profile_sql(),
    "table_row_counts": with_star(_u(
        f"SELECT {_q(t)} AS table_name, COUNT(*) AS rows FROM {GOLD_CTE[t]}"
        for t in GOLD_KEYS)),
    "zorder_layout": with_star("SELECT * FROM fact"),
    "compact": with_star("SELECT * FROM fact"),
})


# --- silver after two batches, and rows that break every rule ---------------------------------

#: Everything was first seen active and then as it is, so the latest rows are silver, deleted or not.
TWO_BATCHES = SILVER[:SILVER.index("s_items AS")] + """s_items AS (SELECT * FROM d_items),
s_orders AS (SELECT * FROM d_orders),
s_products AS (SELECT * FROM d_products),
s_customers AS (SELECT * FROM d_customers)"""


def with_two(body: str) -> str:
    return f"WITH {BRONZE},\n{TWO_BATCHES},\n{GOLD}\n{body}"


FLAWED = """f_customers AS (
  SELECT * REPLACE (CASE WHEN customer_id % 50 = 0 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN customer_id % 7 = 0 THEN 'same' ELSE last_name END AS last_name,
    CASE WHEN customer_id % 13 = 0 THEN 'UNKNOWN' ELSE segment END AS segment,
    CASE WHEN customer_id % 17 = 0 THEN NULL ELSE created_at END AS created_at,
    CASE WHEN customer_id % 11 = 0 THEN NULL WHEN customer_id % 7 = 0 THEN 'same@example.com'
         ELSE email END AS email)
  FROM b_customers),
f_products AS (
  SELECT * REPLACE (CASE WHEN product_id % 50 = 0 THEN NULL ELSE product_id END AS product_id,
    CASE WHEN product_id % 19 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
    CASE WHEN product_id % 23 = 0 THEN 0.0 ELSE cost_price END AS cost_price,
    CASE WHEN product_id % 29 = 0 THEN NULL ELSE name END AS name)
  FROM b_products),
f_orders AS (
  SELECT * REPLACE (CASE WHEN order_id % 50 = 0 THEN NULL ELSE order_id END AS order_id,
    CASE WHEN order_id % 31 = 0 THEN 'lost' ELSE order_status END AS order_status,
    CASE WHEN order_id % 37 = 0 THEN -total_amount ELSE total_amount END AS total_amount,
    CASE WHEN order_id % 41 = 0 THEN NULL ELSE customer_id END AS customer_id)
  FROM b_orders),
f_items AS (
  SELECT * REPLACE (CASE WHEN order_id % 43 = 0 THEN -quantity ELSE quantity END AS quantity,
    CASE WHEN order_id % 47 = 0 THEN 0.0 ELSE line_total END AS line_total,
    CASE WHEN order_id % 53 = 0 THEN NULL ELSE unit_price END AS unit_price,
    CASE WHEN order_id % 50 = 0 THEN NULL ELSE line_number END AS line_number)
  FROM b_items)"""
FLAWED_CTE = {"customers": "f_customers", "products": "f_products", "orders": "f_orders",
              "order_items": "f_items"}
# the gold frames take such rows as silver, but for products: whole and once each
FLAWED_SILVER = f"""d_products AS ({latest('f_products', 'product_id')}),
s_items AS (SELECT * FROM f_items), s_orders AS (SELECT * FROM f_orders),
s_products AS (SELECT * FROM d_products WHERE is_deleted = false AND product_id IS NOT NULL),
s_customers AS (SELECT * FROM f_customers)"""
FLAWED_GOLD = GOLD.replace(dim_date_sql(*FIXTURE_CALENDAR), dim_date_sql(*SHORT_CALENDAR))


def with_flawed(body: str) -> str:
    return f"WITH {BRONZE},\n{FLAWED},\n{FLAWED_SILVER},\n{FLAWED_GOLD}\n{body}"


def silver_quality_body(cte: dict[str, str]) -> str:
    sql = silver_quality_sql()
    return _renamed(sql[sql.index("SELECT * FROM (SELECT 'customers'"):], cte)


def constraints_body(cte: dict[str, str]) -> str:
    sql = constraints_sql()
    return _renamed(sql[sql.index('SELECT table_name, "check"'):], cte)


def _renamed(body: str, cte: dict[str, str]) -> str:
    for n, name in SILVER_CTE.items():
        body = body.replace(f"FROM {name}", f"FROM {cte[n]}")
    return body


def gold_quality_body() -> str:
    sql = gold_quality_sql()
    return sql[sql.index("SELECT * FROM (SELECT 'dim_date'"):]


FK_BODY = FK_SQL[FK_SQL.index("SELECT 'customer_fk'"):]


def duplicate_list_sql() -> str:
    parts = []
    for n in ENTITY_ORDER:
        keys = FIXTURE_ENTITIES[n].keys
        text = " || ',' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in keys)
        parts.append(f"SELECT {_q(n)} AS table_name, {text} AS key, COUNT(*) AS n FROM "
                     f"{BRONZE_CTE[n]} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1")
    return f"WITH {BRONZE}\n{_u(parts)}"


QUERIES.update({
    "dim_customer_two_batches": with_two("SELECT * FROM dim_customer"),
    "dim_product_two_batches": with_two("SELECT * FROM dim_product"),
    "fact_order_line_two_batches": with_two("SELECT * FROM fact"),
    "silver_quality_two_batches": with_two(silver_quality_body(SILVER_CTE)),
    "pk_nulls_flawed": with_flawed(pk_nulls_body(FLAWED_CTE)),
    "silver_quality_flawed": with_flawed(silver_quality_body(FLAWED_CTE)),
    "check_constraints_flawed": with_flawed(constraints_body(FLAWED_CTE)),
    "gold_quality_flawed": with_flawed(gold_quality_body()),
    "fk_orphans_flawed": with_flawed(FK_BODY),
    "metric_sanity_flawed": with_flawed(
        "SELECT COUNT(*) FILTER (WHERE quantity < 0 OR unit_price < 0 OR line_total < 0) "
        "AS negative_rows FROM fact"),
    "gate_failures": with_flawed(
        f"SELECT table_name || '.' || \"column\" || ' nulls: ' || n AS failure FROM "
        f"({pk_nulls_body(FLAWED_CTE)}) WHERE n > 0"),
    "duplicate_key_list": duplicate_list_sql(),
    "table_sample_rows": with_star("SELECT COUNT(*) AS sampled, COUNT(*) AS held FROM "
                                   "(SELECT * FROM fact LIMIT 5)"),
    "create_table_twice": f"WITH {B_ORDERS}\nSELECT * FROM b_orders",
    "namespace_selected": "SELECT 'spark_catalog' AS catalog, 'strata_selected' AS namespace, "
                          "COUNT(*) AS rows FROM orders",
    "overwrite_schema": DIM_DATE_SPAN,
})

# --- whole runs ---------------------------------------------------------------------------------

_LINES = GOLD[GOLD.index("SELECT i.order_id"):].rsplit(")", 1)[0]
#: Lines after the second run, and lines of the first run that no line has replaced.
TWO_RUNS = f"""WITH {BRONZE},
{SILVER},
first_items AS (SELECT * FROM (WITH {BATCHES} {FIRST}) WHERE is_deleted = false),
both_items AS ({QUERIES['stream_upsert']}),
fact1 AS ({_LINES.replace('s_items', 'first_items')}),
fact2 AS ({_LINES.replace('s_items', 'both_items')})
SELECT * FROM fact2 UNION ALL
SELECT * FROM fact1 WHERE NOT EXISTS (SELECT 1 FROM fact2 WHERE fact2.order_id = fact1.order_id
  AND fact2.line_number = fact1.line_number)"""


def _counts(layer: str, names: dict[str, str], times: int = 1) -> list[str]:
    return [f"SELECT {_q(layer)} AS layer, {_q(n)} AS table_name, {times} * COUNT(*) AS rows FROM {c}"
            for n, c in names.items()]


_EVENT = "event_id % 50"
QUERIES.update({
    "pipeline_two_batches": TWO_RUNS,
    "pipeline_late_batch": with_star("SELECT * FROM fact"),
    "pipeline_full_reload": with_star(_u(
        _counts("bronze", BRONZE_CTE, 2) + _counts("silver", SILVER_CTE) + _counts("gold", GOLD_CTE))),
    "pipeline_cancel_after_load": with_star(K3),
    "extract_run": f"""WITH {BRONZE},
landed AS (
  SELECT 'orders' AS table_name, CASE WHEN updated_at >= TIMESTAMP '1999-01-01' THEN 'run000002'
    ELSE 'run000001' END AS batch, COUNT(*) AS rows FROM b_orders GROUP BY ALL
  UNION ALL SELECT 'products', 'run000001', COUNT(*) FROM b_products)
SELECT table_name, batch, rows, CASE table_name WHEN 'orders' THEN (SELECT max(updated_at) FROM b_orders)
  ELSE (SELECT max(updated_at) FROM b_products) END AS high_water_mark FROM landed""",
    "ingest_malformed_json": f"""
SELECT CASE WHEN {_EVENT} <> 7 THEN event_id END AS event_id,
  CASE WHEN {_EVENT} <> 7 THEN user_id END AS user_id,
  CASE WHEN {_EVENT} <> 7 THEN event_type END AS event_type,
  CASE WHEN {_EVENT} NOT IN (7, 21) THEN value END AS value,
  CASE WHEN {_EVENT} = 7 THEN '{{"event_id' END AS _corrupt_record,
  CASE {_EVENT} WHEN 13 THEN '{{"extra":"e' || event_id || '"}}' WHEN 21 THEN '{{"value":"n/a"}}' END
    AS _rescued,
  CASE {_EVENT} WHEN 7 THEN 'malformed line' WHEN 21 THEN 'uncastable: value' END AS _rejected,
  CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END::INTEGER AS _batch_id
FROM events""",
    "pipeline_quarantine": with_star("""
SELECT 'quarantine: ' || CASE order_id % 50 WHEN 3 THEN 'order_id' WHEN 7 THEN 'malformed line'
  ELSE 'uncastable: total_amount' END AS what, COUNT(*) AS rows
FROM b_orders WHERE order_id % 50 IN (3, 7, 21) GROUP BY ALL
UNION ALL SELECT 'rescued: ' || CASE order_id % 50 WHEN 13 THEN 'unknown extra'
  ELSE 'uncastable total_amount' END, COUNT(*) FROM b_orders WHERE order_id % 50 IN (13, 21) GROUP BY ALL
UNION ALL SELECT 'silver', COUNT(*) FROM s_orders WHERE order_id % 50 NOT IN (3, 7, 21)"""),
})
