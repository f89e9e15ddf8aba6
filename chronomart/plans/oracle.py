"""ANSI SQL of the table roles, composed into the check query of each operator."""

from __future__ import annotations

START = "TIMESTAMP '1995-06-01 08:00:00'"


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100.0) AS BIGINT)"


def half_up(num: str, den: str) -> str:
    size = f"((abs({num}) * 2 + nullif({den}, 0)) // (nullif({den}, 0) * 2))"
    return f"(CASE WHEN {num} < 0 THEN -{size} ELSE {size} END)"


def money(total: str) -> str:
    return f"CAST({total} AS DOUBLE) / 100.0"


def scd2(
    source: str, name: str, key: str, tracked: list[str], carried: list[str], valid_from: str, tiebreak: list[str],
    key_name: str,
) -> str:
    """CTE ``name``: the version history of ``source``, told by places: a row is compared with the one a place before it."""
    order = ", ".join(f"{c} ASC NULLS LAST" for c in [valid_from, *tiebreak])
    differs = " OR ".join(f"here.{c} <> earlier.{c}" for c in tracked)
    shown = ", ".join(f"v.{c}" for c in [*carried, *tracked])
    return f"""{name}_places AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place FROM {source}),
{name}_versions AS (
  SELECT here.*, row_number() OVER (PARTITION BY here.{key} ORDER BY here.place) AS version
  FROM {name}_places here LEFT JOIN {name}_places earlier
    ON earlier.{key} IS NOT DISTINCT FROM here.{key} AND earlier.place = here.place - 1
  WHERE earlier.{tracked[0]} IS NULL OR {differs}),
{name} AS (
  SELECT md5(concat_ws('-', CAST(v.{key} AS VARCHAR), CAST(v.{valid_from} AS VARCHAR))) AS {key_name}, v.{key}, {shown},
         v.{valid_from} AS valid_from, n.{valid_from} AS valid_to, n.{valid_from} IS NULL AS is_current
  FROM {name}_versions v LEFT JOIN {name}_versions n
    ON n.{key} IS NOT DISTINCT FROM v.{key} AND n.version = v.version + 1)"""


USER_DIM_ALL = scd2("events", "user_dim", "user_id", ["event_type"], [], "ts", ["event_id"], "user_key")
USER_EVENTS = "user_events AS (SELECT * FROM events WHERE event_type <> 'purchase')"
USER_DIM = USER_EVENTS + ",\n" + scd2(
    "user_events", "user_dim", "user_id", ["event_type"], [], "ts", ["event_id"], "user_key"
)
PURCHASES = "purchases AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')"
PRICE_DIM = scd2(
    "lineitem", "price_dim", "l_partkey", ["l_discount"], ["l_returnflag"], "l_shipdate",
    ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], "price_key",
)
PIT = """SELECT f.event_id, f.user_id, f.ts, f.value, d.user_key, d.event_type AS last_seen
FROM purchases f LEFT JOIN user_dim d
  ON f.user_id = d.user_id AND f.ts >= d.valid_from AND (f.ts < d.valid_to OR d.valid_to IS NULL)"""

EVENT_OP = """CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'insert'
  WHEN 'error' THEN 'delete' ELSE 'update' END"""
EVENT_TABLE = "CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'customers' END"
CHANGES = f"""changes AS (
  SELECT {EVENT_TABLE} AS "table", {EVENT_OP} AS operation, user_id, event_type, value, ts, event_id AS change_id
  FROM events)"""

# staging rows of the retail log ---------------------------------------------

STAGE_CUSTOMERS = f"""st_customers AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id, '  ' || c_name || ' ' AS name,
         ' ' || upper(c_name) || '@Example.COM' AS email, c_mktsegment || ' ' AS address,
         'c' AS operation, {START} AS valid_from, {START} AS captured_at, {START} AS created_at,
         {START} AS updated_at, CAST(c_custkey AS BIGINT) AS change_id
  FROM customer
  UNION ALL
  SELECT CAST(o_custkey AS BIGINT), 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'),
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com', ' ' || o_orderpriority,
         'update', o_orderdate + INTERVAL 30 DAY, o_orderdate + INTERVAL 30 DAY, {START},
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 30 DAY END, 10000000000 + o_orderkey
  FROM orders)"""

STAGE_PRODUCTS = f"""st_products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS name, p_brand AS category, p_retailprice AS price,
         'insert' AS operation, {START} AS valid_from, {START} AS captured_at, {START} AS updated_at,
         CAST(p_partkey AS BIGINT) AS change_id
  FROM part
  UNION ALL
  SELECT CAST(l_partkey AS BIGINT), 'Part ' || CAST(l_partkey AS VARCHAR), ' ' || l_returnflag || ' ',
         CASE WHEN l_tax = 0 THEN 0.0 ELSE l_discount END, 'u', l_shipdate, l_shipdate, l_shipdate,
         10000000000 + l_orderkey * 8 + l_linenumber
  FROM lineitem)"""

STAGE_ORDERS = """st_orders AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
         o_orderdate AS order_date, 'pending' AS status, o_totalprice AS total_amount, 'insert' AS operation,
         o_orderdate AS captured_at, o_orderkey * 2 AS change_id
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS BIGINT), CAST(o_custkey AS BIGINT), o_orderdate,
         CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN ' shipped'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'cancelled' ELSE 'PENDING ' END,
         o_totalprice, 'u', o_orderdate + INTERVAL 3 DAY, o_orderkey * 2 + 1
  FROM orders)"""

STAGE_ITEMS = """st_items AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS order_item_id, CAST(l_orderkey AS BIGINT) AS order_id,
         CAST(l_partkey AS BIGINT) AS product_id,
         CASE WHEN l_tax = 0 THEN 1 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         l_extendedprice AS unit_price, CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'insert' END AS operation,
         l_shipdate AS captured_at, l_partkey AS change_id
  FROM lineitem)"""

STAGE_INVENTORY = """st_inventory AS (
  SELECT CAST(l_partkey AS BIGINT) AS product_id, 'W' || CAST(l_suppkey AS VARCHAR) AS warehouse_id,
         CASE WHEN l_tax = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS stock_level, 'update' AS operation,
         l_shipdate AS captured_at, l_shipdate AS updated_at, l_orderkey * 8 + l_linenumber AS change_id
  FROM lineitem)"""

STG_CUSTOMERS = """stg_customers AS (
  SELECT customer_id, trim(name) AS name, lower(trim(email)) AS email, trim(address) AS address, operation,
         valid_from, captured_at, created_at, updated_at, change_id FROM st_customers)"""

STG_PRODUCTS = """stg_products AS (
  SELECT product_id, trim(name) AS name, trim(category) AS category, CAST(price AS DOUBLE) AS price, operation,
         valid_from, captured_at, updated_at, change_id FROM st_products)"""


def newest(source: str, name: str, key: str, columns: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY captured_at DESC, change_id DESC) AS rn FROM {source})
  WHERE rn = 1 AND {where})"""


_ORDER_COLUMNS = (
    "order_id, customer_id, order_date, lower(trim(status)) AS status, CAST(total_amount AS DOUBLE) AS total_amount, "
    "captured_at AS last_updated_at"
)
STG_ORDERS = newest("st_orders", "stg_orders", "order_id", _ORDER_COLUMNS)
_ITEM_COLUMNS = (
    "order_item_id, order_id, product_id, quantity, unit_price, "
    f"{money(cents('quantity * unit_price'))} AS item_subtotal, captured_at"
)
STG_ITEMS = newest("st_items", "stg_items", "order_item_id", _ITEM_COLUMNS)
STG_ITEMS_DROP = newest("st_items", "stg_items", "order_item_id", _ITEM_COLUMNS, "operation <> 'delete'")
STG_INVENTORY = newest(
    "st_inventory", "stg_inventory", "product_id", "product_id, warehouse_id, stock_level, captured_at, updated_at"
)

CUSTOMER_DIM = ",\n".join([
    STAGE_CUSTOMERS, STG_CUSTOMERS,
    scd2("stg_customers", "dim_customers", "customer_id", ["address", "email"], ["name"], "valid_from",
         ["captured_at", "change_id"], "customer_key"),
])
PRODUCT_DIM = ",\n".join([
    STAGE_PRODUCTS, STG_PRODUCTS,
    scd2("stg_products", "dim_products", "product_id", ["price", "category"], ["name"], "valid_from",
         ["captured_at", "change_id"], "product_key"),
])
SUMMARY = f"""summary AS (
  SELECT order_id, count(order_item_id) AS total_items, CAST(sum(quantity) AS BIGINT) AS total_quantity,
         {money(f"CAST(sum({cents('item_subtotal')}) AS BIGINT)")} AS calculated_item_total
  FROM stg_items GROUP BY order_id)"""
# An order's items as correlated sub-queries: what there is not counts as nothing.
ORDERS_BASE = ",\n".join([STAGE_ORDERS, STG_ORDERS, STAGE_ITEMS, STG_ITEMS, SUMMARY, """orders_base AS (
  SELECT order_id, customer_id, order_date, status, total_amount,
         (SELECT count(i.order_item_id) FROM stg_items i WHERE i.order_id = stg_orders.order_id) AS total_items,
         ifnull((SELECT CAST(sum(i.quantity) AS BIGINT) FROM stg_items i WHERE i.order_id = stg_orders.order_id), 0) AS total_quantity
  FROM stg_orders)"""])
# The last version that starts by order time, if it has not ended.
FACTS = ",\n".join([CUSTOMER_DIM, ORDERS_BASE, """fct AS (
  SELECT order_id, CASE WHEN ifnull(order_date < lived.valid_to, TRUE) THEN lived.customer_key END AS customer_key,
         orders_base.customer_id, order_date, status, total_amount, total_items, total_quantity
  FROM orders_base ASOF LEFT JOIN (FROM dim_customers WHERE valid_to IS NULL OR valid_to > valid_from) lived
    ON lived.customer_id = orders_base.customer_id AND orders_base.order_date >= lived.valid_from)"""])
# Sums per day and state first, days from those.
DAILY = f"""states AS (
  SELECT CAST(order_date AS DATE) AS sale_date, status, count(order_id) AS n, count(total_amount) AS priced,
         CAST(sum({cents('total_amount')}) AS BIGINT) AS cents, CAST(sum(total_quantity) AS BIGINT) AS units
  FROM fct GROUP BY ALL),
days AS (
  SELECT sale_date, CAST(sum(n) AS BIGINT) AS total_orders, CAST(sum(units) AS BIGINT) AS total_units_sold,
         CAST(ifnull(sum(cents) FILTER (status <> 'cancelled'), 0) AS BIGINT) AS gross,
         CAST(ifnull(sum(priced) FILTER (status <> 'cancelled'), 0) AS BIGINT) AS sold,
         CAST(ifnull(sum(cents) FILTER (status = 'delivered'), 0) AS BIGINT) AS delivered,
         map_from_entries(list((status, n))) AS orders_of
  FROM states GROUP BY sale_date),
daily AS (
  SELECT sale_date, total_orders, {money('gross')} AS gross_revenue, {money('delivered')} AS delivered_revenue,
         ifnull(orders_of['delivered'], 0) AS delivered_orders, ifnull(orders_of['shipped'], 0) AS shipped_orders,
         ifnull(orders_of['pending'], 0) AS pending_orders, ifnull(orders_of['cancelled'], 0) AS cancelled_orders,
         ifnull({money(half_up('gross', 'sold'))}, 0.0) AS average_order_value, total_units_sold,
         {money(half_up("ifnull(orders_of['cancelled'], 0) * 10000", 'total_orders'))} AS cancellation_rate_pct
  FROM days)"""
DAILY_ALL = FACTS + ",\n" + DAILY
