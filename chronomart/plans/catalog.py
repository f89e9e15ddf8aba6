"""The operators as queries over the shared test tables, each with its check in SQL."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.functions.aggregates import avg_if, count_if, sum_money_if
from chronomart.functions.money import mean_money, percent, round_money, sum_money
from chronomart.functions.payload import field, get_or, to_double, to_whole
from chronomart.functions.times import capture_date, fmt_ts, parse_ts
from chronomart.operators import diff, envelope, facts, joins, latest, marts, quality, scd2, staging
from chronomart.operators.errors import error_counts
from chronomart.plans import oracle as o
from chronomart.plans import retail, roles
from chronomart.schemas import ENVELOPE, ROW_IMAGE
from chronomart.sources import changelog
from chronomart.sources.growing import read_growing
from chronomart.sources.scratch import new_path, shuffles_dropped
from chronomart.streaming.dedupe import start_deduped
from chronomart.streaming.ingest import ONCE, append_new, dedupe_stream, gate_batch, ingest_stream
from chronomart.streaming.maintain import IncrementalWarehouse, maintain_stream
from chronomart.streaming.windows import daily_sales_stream, read_windows, start_windows


@dataclass(frozen=True)
class Query:
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    def register(run):
        CATALOG[name] = Query(covers, run, sql)
        return run

    return register


def _t(name: str):
    return lambda spark, sf: roles.table(spark, sf, name)


events, orders, lineitem, customer, part = (_t(n) for n in ("events", "orders", "lineitem", "customer", "part"))


def user_dim(spark, sf) -> DataFrame:
    return scd2.scd2(roles.user_events(events(spark, sf)), roles.USERS)


def price_dim(spark, sf) -> DataFrame:
    return scd2.scd2(lineitem(spark, sf), roles.PRICES)


VIEWS = {
    "stg_customers": (staging.stage_customers, staging.stg_customers),
    "stg_products": (staging.stage_products, staging.stg_products),
    "stg_orders": (staging.stage_orders, staging.stg_orders),
    "stg_order_items": (staging.stage_order_items, staging.stg_order_items),
    "stg_inventory": (staging.stage_inventory, staging.stg_inventory),
}


def view(spark, sf, name: str, *args) -> DataFrame:
    """One staging view over the log of its table."""
    stage, clean = VIEWS[name]
    return clean(stage(roles.retail_log(spark, sf, name.removeprefix("stg_"))), *args)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """A model as its readers see it: a stored table, computed once."""
    return changelog.refresh(df, new_path(df.sparkSession, name), **options)


def customer_dim(spark, sf) -> DataFrame:
    return scd2.dim_customers_scd2(view(spark, sf, "stg_customers"))


def product_dim(spark, sf) -> DataFrame:
    """Events are parsed once: the count of hot groups and the history both read the stored view."""
    rows = view(spark, sf, "stg_products").drop("operation", "updated_at")
    return scd2.dim_products_scd2(stored(rows, "stg-products"))


def order_facts(spark, sf, method: str = "auto") -> DataFrame:
    return facts.fct_orders(
        view(spark, sf, "stg_orders"), view(spark, sf, "stg_order_items"),
        stored(customer_dim(spark, sf), "dim-customers"), method,
    )


# change log -------------------------------------------------------------------


@query("envelope_roundtrip", "S1 E1 E2 E3 E4 F13 F16 F17", f"""
WITH {o.CHANGES}
SELECT "table", operation, user_id, event_type, value, ts AS captured_at, change_id FROM changes""")
def _(spark, sf):
    parsed = envelope.parse_envelope(roles.events_json(events(spark, sf)))
    good, _bad = envelope.validate_envelope(parsed)
    image = F.col("payload")
    return envelope.payload(good).select(
        "table", "operation", field(image, "user_id").cast("bigint").alias("user_id"),
        field(image, "type").alias("event_type"), to_double(field(image, "value")).alias("value"),
        parse_ts(F.col("captured_at")).alias("captured_at"), "change_id",
    )


@query("json_bronze_scan", "S1 S2 E6", f"""
WITH {o.CHANGES}
SELECT operation, CAST(count(*) AS BIGINT) AS events, CAST(max(change_id) AS BIGINT) AS last_change
FROM changes WHERE "table" = 'orders' GROUP BY operation""")
def _(spark, sf):
    """JSON lines, one folder per table; one folder is read back."""
    path = new_path(spark, "json-bronze")
    log = roles.events_envelope(events(spark, sf))
    for name in ("orders", "customers"):
        envelope.route(log, name).write.json(f"{path}/{name}")
    good, _bad = envelope.validate_envelope(changelog.read_changes(spark, path, "orders", fmt="json"))
    return good.groupBy("operation").agg(
        F.count(F.lit(1)).alias("events"), F.max("change_id").alias("last_change")
    )


@query("bronze_write_read", "K1 S2 E11", f"""
WITH {o.CHANGES}
SELECT "table", CAST(ts AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS events FROM changes
WHERE "table" = 'customers' GROUP BY "table", CAST(ts AS DATE)""")
def _(spark, sf):
    path = new_path(spark, "bronze")
    changelog.write_bronze(roles.events_envelope(events(spark, sf)), path)
    return changelog.read_changes(spark, path, "customers").groupBy("table", "event_date").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("bronze_summary", "K2", f"""
WITH {o.CHANGES} SELECT "table", CAST(count(*) AS BIGINT) AS events FROM changes GROUP BY "table" """)
def _(spark, sf):
    return changelog.bronze_summary(roles.events_envelope(events(spark, sf)))


@query("raw_event_table", "K3 F19", f"""
WITH {o.CHANGES}
SELECT "table" AS table_name, operation IN ('insert', 'update') AS has_after,
       CAST(count(*) AS BIGINT) AS events, CAST(count(*) AS BIGINT) AS loaded
FROM changes GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "raw-events")
    changelog.write_raw_events(roles.events_envelope(events(spark, sf)), path)
    return spark.read.parquet(path).groupBy(
        "table_name", F.col("after_state").isNotNull().alias("has_after")
    ).agg(F.count("change_id").alias("events"), F.count("loaded_at").alias("loaded"))


@query("staging_refresh", "K4 S6", """
SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)""")
def _(spark, sf):
    """Refreshed twice: the second run replaces the first."""
    path = new_path(spark, "staging")
    log = roles.retail_log(spark, sf, "orders")
    changelog.refresh(staging.stage_orders(log), path)
    again = changelog.refresh(staging.stage_orders(log), path)
    return again.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("orders"))


@query("materialized_models", "K5 K6 S7", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY o_orderstatus""")
def _(spark, sf):
    """A view over the source, a stored table over the view."""
    source = changelog.materialize(orders(spark, sf), "orders_view", "view")
    model = source.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return changelog.materialize(model, "orders_by_status", "table", new_path(spark, "model"))


@query("source_scan", "S4", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def _(spark, sf):
    return changelog.read_source(spark, "supplier", path=f"{sf}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")


@query("incremental_scan", "S3 F16", f"""
WITH {o.CHANGES}
SELECT "table", operation, CAST(count(*) AS BIGINT) AS events, CAST(min(change_id) AS BIGINT) AS first_change
FROM changes WHERE change_id > (SELECT CAST(max(event_id) AS BIGINT) // 2 FROM events) GROUP BY "table", operation""")
def _(spark, sf):
    log = roles.events_envelope(events(spark, sf))
    mark = changelog.high_water_mark(log) // 2
    return changelog.read_changes_since(log, mark).groupBy("table", envelope.normalize_op(F.col("operation")).alias("operation")).agg(
        F.count(F.lit(1)).alias("events"), F.min("change_id").alias("first_change")
    )


@query("incremental_scan_late_ids", "S3", f"""
WITH {o.CHANGES}
SELECT "table", operation, CAST(count(*) AS BIGINT) AS events,
       CAST(CASE WHEN operation <> 'delete' THEN min(change_id) END AS BIGINT) AS first_change
FROM changes WHERE operation <> 'update' GROUP BY "table", operation""")
def _(spark, sf):
    """Updates are processed; the others come later with smaller ids, deletes without any."""
    log = roles.events_envelope(events(spark, sf)).withColumn("operation", envelope.normalize_op(F.col("operation")))
    log = log.withColumn("change_id", F.when(F.col("operation") != "delete", F.col("change_id")))
    marks = changelog.processed_marks(log.filter("operation = 'update'"))
    return changelog.read_unprocessed(log, marks).groupBy("table", "operation").agg(
        F.count(F.lit(1)).alias("events"), F.min("change_id").alias("first_change")
    )


@query("change_table_scan", "E1 S3 S4", """
SELECT event_id AS change_id, user_id, event_type = 'error' AS is_delete FROM events""")
def _(spark, sf):
    """A relational change log with JSON text images and empty text for no image."""
    log = roles.events_envelope(events(spark, sf))
    rows = log.select(
        "change_id", F.col("table").alias("table_name"), "operation",
        F.coalesce(F.to_json("before"), F.lit("")).alias("before_state"),
        F.coalesce(F.to_json("after"), F.lit("")).alias("after_state"), "captured_at",
    )
    read = envelope.payload(envelope.from_change_table(rows))
    return read.select(
        "change_id", field(F.col("payload"), "user_id").cast("bigint").alias("user_id"),
        F.col("after").isNull().alias("is_delete"),
    )


@query("connector_messages", "E10 S5", """
SELECT 'customers' AS "table", CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'insert'
  WHEN 'error' THEN 'delete' ELSE 'update' END AS operation, user_id, date_trunc('millisecond', ts) AS captured_at,
  event_id AS change_id FROM events""")
def _(spark, sf):
    row = F.struct("user_id", "value")
    gone = F.col("event_type") == "error"
    code = F.when(F.col("event_type").isin("signup"), "c").when(gone, "d").when(F.col("event_type") == "purchase", "r").otherwise("u")
    body = F.struct(
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"),
        F.struct(F.lit("customers").alias("table"), F.col("event_id").alias("lsn")).alias("source"),
        code.alias("op"),
        F.floor(F.unix_micros(F.col("ts").cast("string").cast("timestamp")) / 1000).alias("ts_ms"),
    )
    wrapped = F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"), body.alias("payload"))
    text = F.when(F.col("event_type") == "view", F.to_json(wrapped)).otherwise(F.to_json(body))
    log = envelope.from_connector(events(spark, sf).select(text.alias("value")))
    return envelope.payload(log).select(
        "table", "operation", field(F.col("payload"), "user_id").cast("bigint").alias("user_id"),
        parse_ts(F.col("captured_at")).alias("captured_at"), "change_id",
    )


@query("invalid_envelopes", "E2", """
SELECT CAST(count(*) FILTER (WHERE event_type IN ('signup', 'error', 'click', 'view')) AS BIGINT) AS valid_events,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS invalid_events FROM events""")
def _(spark, sf):
    """Purchases get an operation in capitals and broken JSON for half of the users."""
    spoiled = roles.events_envelope(events(spark, sf)).select(
        F.when(F.col("table") == "orders", F.when(F.col("change_id") > F.col("after")["user_id"].cast("bigint") * 100,
               F.lit('{"table": "orders", ')).otherwise(F.to_json(F.struct("table", F.upper("operation").alias("operation"), "captured_at"))))
        .otherwise(F.to_json(F.struct("*"))).alias("value")
    )
    parsed = envelope.parse_envelope(spoiled)
    return parsed.agg(
        F.count_if(envelope.is_valid_envelope(parsed)).alias("valid_events"),
        F.count_if(~envelope.is_valid_envelope(parsed)).alias("invalid_events"),
    )


@query("operation_invariants", "E5", """
WITH t AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'customers' END AS "table",
         CASE event_id % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS operation,
         event_id % 5 < 2 AS b, event_id % 7 < 4 AS a FROM events)
SELECT "table", operation, CAST(count(*) AS BIGINT) AS events,
       count(*) FILTER (operation = 'insert' AND b) AS insert_with_before, count(*) FILTER (operation = 'insert' AND NOT a) AS insert_without_after,
       count(*) FILTER (operation = 'update' AND NOT b) AS update_without_before, count(*) FILTER (operation = 'update' AND NOT a) AS update_without_after,
       count(*) FILTER (operation = 'delete' AND a) AS delete_with_after, count(*) FILTER (operation = 'delete' AND NOT b) AS delete_without_before
FROM t GROUP BY ALL""")
def _(spark, sf):
    """Events whose images are there or not whatever the operation: every rule is broken by some."""
    image = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"))
    n = F.col("event_id")
    none = F.when(n % 2 == 0, F.lit(None).cast(ROW_IMAGE)).otherwise(F.create_map().cast(ROW_IMAGE))
    log = events(spark, sf).select(
        F.when(F.col("event_type") == "purchase", "orders").otherwise("customers").alias("table"),
        F.when(n % 3 == 0, "insert").when(n % 3 == 1, "u").otherwise("delete").alias("operation"),
        F.when(n % 5 < 2, image).otherwise(none).alias("before"), F.when(n % 7 < 4, image).otherwise(none).alias("after"),
        F.col("ts").cast("string").alias("captured_at"), n.alias("change_id"),
    )
    return envelope.check_invariants(log)


@query("operation_invariants_retail", "E5", """
WITH t AS (
  SELECT 'customers' AS "table", 'insert' AS operation, count(*) AS n FROM customer
  UNION ALL SELECT 'customers', 'update', count(*) FROM orders
  UNION ALL SELECT 'products', 'insert', count(*) FROM part
  UNION ALL SELECT 'products', 'update', count(*) FROM lineitem
  UNION ALL SELECT 'orders', 'insert', count(*) FROM orders
  UNION ALL SELECT 'orders', 'update', count(*) FROM orders
  UNION ALL SELECT 'order_items', CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'insert' END, count(*)
            FROM lineitem GROUP BY l_returnflag = 'R'
  UNION ALL SELECT 'inventory', 'update', count(*) FROM lineitem)
SELECT "table", operation, CAST(n AS BIGINT) AS events,
       CAST(CASE WHEN operation = 'update' THEN n ELSE 0 END AS BIGINT) AS update_without_before FROM t""")
def _(spark, sf):
    found = envelope.check_invariants(roles.retail_log(spark, sf))
    return found.select("table", "operation", "events", "update_without_before")


@query("change_stats", "E7", f"""
WITH {o.CHANGES}
SELECT "table", operation, CASE WHEN grouping("table") = 0 THEN 'table' WHEN grouping(operation) = 0 THEN 'operation'
  ELSE 'total' END AS breakdown, CAST(count(*) AS BIGINT) AS events
FROM changes GROUP BY GROUPING SETS (("table"), (operation), ())""")
def _(spark, sf):
    log = roles.events_envelope(events(spark, sf)).withColumn("operation", envelope.normalize_op(F.col("operation")))
    return envelope.change_stats(log)


@query("sample_events", "E8", f"""
WITH {o.CHANGES}
SELECT "table", operation, user_id, change_id FROM (
  SELECT *, row_number() OVER (PARTITION BY "table", operation ORDER BY change_id) AS n FROM changes) WHERE n = 1""")
def _(spark, sf):
    log = roles.events_envelope(events(spark, sf)).withColumn("operation", envelope.normalize_op(F.col("operation")))
    return envelope.payload(envelope.sample_events(log)).select(
        "table", "operation", field(F.col("payload"), "user_id").cast("bigint").alias("user_id"), "change_id"
    )


@query("capture_dates", "E11 F13 F7", """
SELECT CAST(ts + INTERVAL 5 HOUR AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS events,
       min(ts) AS first_utc, max(ts) AS last_utc FROM events GROUP BY ALL""")
def _(spark, sf):
    """Text in a +05:00 offset: the date is the event's own, the time is UTC."""
    text = events(spark, sf).select(F.expr(roles.iso("ts", 5)).alias("captured_at"))
    utc = parse_ts(F.col("captured_at"))
    return text.groupBy(capture_date(F.col("captured_at")).alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"), F.min(utc).alias("first_utc"), F.max(utc).alias("last_utc")
    )


SNAPSHOT_DIFF = """
WITH new_c AS (
  SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT c_custkey + 1000000000, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT coalesce(n.c_custkey, c.c_custkey) AS c_custkey,
       CASE WHEN c.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS operation,
       c.c_acctbal AS before_balance, n.c_acctbal AS after_balance
FROM customer c FULL JOIN new_c n ON c.c_custkey = n.c_custkey
WHERE c.c_custkey IS NULL OR n.c_custkey IS NULL OR c.c_acctbal <> n.c_acctbal"""


def snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customers, and the same with balances raised, debtors removed and customers added."""
    old = customer(spark, sf).select("c_custkey", "c_name", "c_acctbal")
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    kept = customer(spark, sf).filter("c_acctbal >= 0").select("c_custkey", "c_name", raised.alias("c_acctbal"))
    added = customer(spark, sf).filter("c_mktsegment = 'MACHINERY'").select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name", "c_acctbal"
    )
    return old, kept.unionByName(added)


def balances(changes: DataFrame) -> DataFrame:
    def balance(state):
        return to_double(field(F.from_json(state, ROW_IMAGE), "c_acctbal"))

    return changes.select(
        "c_custkey", "operation", balance("before_state").alias("before_balance"),
        balance("after_state").alias("after_balance"),
    )


@query("snapshot_diff", "E9 J7 F16", SNAPSHOT_DIFF)
def _(spark, sf):
    return balances(diff.snapshot_diff(*snapshots(spark, sf), ["c_custkey"], "customers"))


@query("snapshot_diff_stored", "E9 J7 U2", SNAPSHOT_DIFF)
def _(spark, sf):
    """Stored snapshots with digests per key bucket; buckets that are alike are not read."""
    paths = [new_path(spark, "snapshot") for _ in range(2)]
    for rows, path in zip(snapshots(spark, sf), paths):
        diff.write_snapshot(rows, path, ["c_custkey"], 64)
    return balances(diff.stored_snapshot_diff(spark, *paths, ["c_custkey"], "customers"))


@query("dedupe_batch", "T2", f"""
WITH {o.CHANGES}
SELECT "table", operation, CAST(count(*) AS BIGINT) AS events, CAST(sum(change_id) AS BIGINT) AS id_sum
FROM changes GROUP BY "table", operation""")
def _(spark, sf):
    """The log with every purchase delivered three times."""
    log = roles.events_envelope(events(spark, sf))
    again = envelope.route(log, "orders")
    clean = envelope.dedupe(log.unionByName(again).unionByName(again))
    return clean.groupBy("table", envelope.normalize_op(F.col("operation")).alias("operation")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("change_id").alias("id_sum")
    )


# staging ----------------------------------------------------------------------

_C = "customer_id, name, email, address, operation, valid_from, captured_at, created_at, updated_at, change_id"
_P = "product_id, name, category, price, operation, valid_from, captured_at, updated_at, change_id"
_O = "order_id, customer_id, order_date, status, total_amount, operation, captured_at, change_id"
_I = "order_item_id, order_id, product_id, quantity, unit_price, operation, captured_at, change_id"
_S = "product_id, warehouse_id, stock_level, operation, captured_at, updated_at, change_id"


def _staged(name: str):
    return lambda spark, sf: staging.STAGES[name](roles.retail_log(spark, sf, name))


def _view(name: str, *args):
    return lambda spark, sf: view(spark, sf, name, *args)


query("stage_customers", "G1 E4 E6", f"WITH {o.STAGE_CUSTOMERS} SELECT {_C} FROM st_customers")(_staged("customers"))
query("stage_products", "G2 G6", f"WITH {o.STAGE_PRODUCTS} SELECT {_P} FROM st_products")(_staged("products"))
query("stage_orders", "G3", f"WITH {o.STAGE_ORDERS} SELECT {_O} FROM st_orders")(_staged("orders"))
query("stage_order_items", "G4 G6", f"WITH {o.STAGE_ITEMS} SELECT {_I} FROM st_items")(_staged("order_items"))
query("stage_inventory", "G5 G6", f"WITH {o.STAGE_INVENTORY} SELECT {_S} FROM st_inventory")(_staged("inventory"))
query("stg_customers", "G7 F1 F2 P1", f"WITH {o.STAGE_CUSTOMERS}, {o.STG_CUSTOMERS} SELECT {_C} FROM stg_customers")(
    _view("stg_customers"))
query("stg_products", "G8 F1 F6", f"WITH {o.STAGE_PRODUCTS}, {o.STG_PRODUCTS} SELECT {_P} FROM stg_products")(
    _view("stg_products"))
query("stg_orders", "G9 W1 F2", f"WITH {o.STAGE_ORDERS}, {o.STG_ORDERS} SELECT * FROM stg_orders")(_view("stg_orders"))
query("stg_order_items", "G10 W1 F8 F18", f"WITH {o.STAGE_ITEMS}, {o.STG_ITEMS} SELECT * FROM stg_items")(
    _view("stg_order_items"))
query("stg_order_items_without_deletes", "G10 W1",
      f"WITH {o.STAGE_ITEMS}, {o.STG_ITEMS_DROP} SELECT * FROM stg_items")(_view("stg_order_items", "drop"))
query("stg_inventory", "G11 W1", f"WITH {o.STAGE_INVENTORY}, {o.STG_INVENTORY} SELECT * FROM stg_inventory")(
    _view("stg_inventory"))


@query("payload_defaults", "G6 F17 F14", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CASE WHEN l_tax = 0 THEN 1 WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity
FROM lineitem""")
def _(spark, sf):
    """Absent key: default. Present but not a number: NULL."""
    image = F.create_map(
        F.lit("quantity"), F.when(F.col("l_returnflag") == "N", "many").otherwise(F.col("l_quantity").cast("string"))
    )
    image = F.when(F.col("l_tax") == 0, F.map_filter(image, lambda k, _: k != "quantity")).otherwise(image)
    rows = lineitem(spark, sf).withColumn("image", image)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        get_or(F.col("image"), "quantity", to_whole, 1).alias("quantity"),
    )


@query("latest_state", "W1", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def _(spark, sf):
    return latest.latest_state(
        lineitem(spark, sf), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )


# dimensions -------------------------------------------------------------------

query("scd2_events", "D6 D1 D2 D3 W2 W3 W4 F3 F4 F5 F11", f"WITH {o.USER_DIM_ALL} SELECT * FROM user_dim")(
    lambda spark, sf: scd2.scd2(events(spark, sf), roles.USERS))
query("scd2_prices", "D6 D5 W2 W3 W4", f"WITH {o.PRICE_DIM} SELECT * FROM price_dim")(price_dim)
query("dim_customers_scd2", "D4 D1 D2 D3", f"""WITH {o.CUSTOMER_DIM}
SELECT customer_key, customer_id, name, email, address, valid_from, valid_to, is_current FROM dim_customers""")(
    customer_dim)
query("dim_products_scd2", "D5 D1 D2 D3", f"""WITH {o.PRODUCT_DIM}
SELECT product_key, product_id, name, category, price, valid_from, valid_to, is_current FROM dim_products""")(
    product_dim)


@query("scd2_null_safe", "D6", """
WITH src AS (SELECT user_id, ts, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events),
raw AS (SELECT *, lag(kind) OVER w AS prev, row_number() OVER w AS n FROM src
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
kept AS (SELECT * FROM raw WHERE n = 1 OR prev IS DISTINCT FROM kind)
SELECT user_id, kind, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM kept""")
def _(spark, sf):
    """Errors hide the state: changes to and from NULL count."""
    rows = events(spark, sf).withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    spec = scd2.Scd2(["user_id"], ["kind"], valid_from="ts", tiebreak=["event_id"], null_safe=True)
    return scd2.scd2(rows, spec).select("user_id", "kind", "valid_from", "valid_to")


@query("scd2_nulls_by_rule", "D1", """
WITH src AS (SELECT user_id, ts, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events),
raw AS (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM src),
kept AS (SELECT * FROM raw WHERE prev IS NULL OR prev <> kind)
SELECT user_id, kind, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM kept""")
def _(spark, sf):
    """The default rule: a change to NULL is none, every row after a NULL opens a version."""
    rows = events(spark, sf).withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    spec = scd2.Scd2(["user_id"], ["kind"], valid_from="ts", tiebreak=["event_id"])
    return scd2.scd2(rows, spec).select("user_id", "kind", "valid_from", "valid_to")


@query("scd2_closed_deletes", "D6", """
WITH src AS (SELECT *, event_type = 'error' AS gone FROM events),
raw AS (SELECT *, lag(event_type) OVER w AS prev, lag(gone) OVER w AS prev_gone FROM src
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
kept AS (SELECT * FROM raw WHERE (prev IS NULL OR prev <> event_type OR prev_gone <> gone)
         AND NOT (gone AND coalesce(prev_gone, TRUE))),
win AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM kept)
SELECT user_id, event_type, ts AS valid_from, valid_to, valid_to IS NULL AS is_current FROM win WHERE NOT gone""")
def _(spark, sf):
    """Errors as deletes that end the open version."""
    rows = events(spark, sf).withColumn("operation", F.when(F.col("event_type") == "error", "delete").otherwise("update"))
    spec = scd2.Scd2(["user_id"], ["event_type"], valid_from="ts", tiebreak=["event_id"], deletes="close")
    return scd2.scd2(rows, spec).select("user_id", "event_type", "valid_from", "valid_to", "is_current")


@query("incremental_equals_full", "D8 T5 U2", f"""
WITH {o.USER_DIM_ALL}
SELECT CAST(count(*) AS BIGINT) AS versions, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
FROM user_dim""")
def _(spark, sf):
    """Clicks arrive after everything else, so most of them are late."""
    rows = events(spark, sf)
    old, new = rows.filter("event_type <> 'click'"), rows.filter("event_type = 'click'")
    updated = scd2.scd2_update(scd2.scd2(old, roles.USERS), old, new, roles.USERS)
    full = scd2.scd2(rows, roles.USERS)
    counts = diff.diff_counts(updated, full)
    return full.agg(F.count(F.lit(1)).alias("versions")).withColumns(
        {c: counts.select(c).scalar() for c in ("only_left", "only_right")}
    )


@query("scd2_incremental", "D8", f"WITH {o.USER_DIM_ALL} SELECT * FROM user_dim")
def _(spark, sf):
    """Purchases of an already built dimension arrive late."""
    rows = events(spark, sf)
    old, new = rows.filter("event_type <> 'purchase'"), rows.filter("event_type = 'purchase'")
    return scd2.scd2_update(scd2.scd2(old, roles.USERS), old, new, roles.USERS)


@query("dim_current", "D9", f"WITH {o.PRICE_DIM} SELECT * FROM price_dim WHERE is_current")
def _(spark, sf):
    return scd2.as_of(price_dim(spark, sf))


@query("dim_as_of", "D9", f"""WITH {o.PRICE_DIM} SELECT * FROM price_dim
WHERE valid_from <= TIMESTAMP '1998-06-15 00:00:00' AND (TIMESTAMP '1998-06-15 00:00:00' < valid_to OR valid_to IS NULL)""")
def _(spark, sf):
    return scd2.as_of(price_dim(spark, sf), "1998-06-15 00:00:00")


@query("entity_history", "P9 P4 O1", f"WITH {o.USER_DIM} SELECT * FROM user_dim WHERE user_id = 8 ORDER BY valid_from")
def _(spark, sf):
    return scd2.history(user_dim(spark, sf), "user_id", 8)


@query("multi_version", "J5 A8 F12", f"""WITH {o.PRODUCT_DIM}
SELECT product_key, product_id, name, category, price, is_current, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
       coalesce(strftime(valid_to, '%Y-%m-%d %H:%M:%S'), 'Active (NULL)') AS valid_to
FROM dim_products WHERE product_id IN (SELECT product_id FROM dim_products GROUP BY product_id HAVING count(*) > 1)""")
def _(spark, sf):
    rows = scd2.multi_version(product_dim(spark, sf), ["product_id"])
    return rows.select(
        "product_key", "product_id", "name", "category", "price", "is_current",
        fmt_ts(F.col("valid_from")).alias("valid_from"),
        F.coalesce(fmt_ts(F.col("valid_to")), F.lit("Active (NULL)")).alias("valid_to"),
    )


@query("version_delta", "W5", f"""WITH {o.PRICE_DIM}, d AS (
  SELECT l_partkey, l_discount, valid_from, valid_to, price_key,
         row_number() OVER w AS version, l_discount - lag(l_discount) OVER w AS delta FROM price_dim
  WINDOW w AS (PARTITION BY l_partkey ORDER BY valid_from, valid_to NULLS LAST, l_discount, l_returnflag))
SELECT l_partkey, l_discount, valid_from, CAST(version AS BIGINT) AS version,
       CAST(CAST(round(delta * 100) AS BIGINT) AS DOUBLE) / 100.0 AS delta FROM d""")
def _(spark, sf):
    rows = scd2.version_delta(
        price_dim(spark, sf), ["l_partkey"], "l_discount", ["valid_to", "l_discount", "l_returnflag"]
    )
    return rows.select("l_partkey", "l_discount", "valid_from", "version", round_money(F.col("delta")).alias("delta"))


# joins ------------------------------------------------------------------------

_PIT_SQL = f"WITH {o.USER_DIM}, {o.PURCHASES} {o.PIT}"


def _pit(method: str):
    def run(spark, sf):
        dim = user_dim(spark, sf).withColumnRenamed("event_type", "last_seen")
        return joins.point_in_time(
            roles.purchases(events(spark, sf)), dim, "user_id", "ts", "user_id", ["user_key", "last_seen"],
            ["event_id"], method,
        )

    return run


query("pit_join", "J2 P6 P7", _PIT_SQL)(_pit("interval"))
query("asof_join", "J3", _PIT_SQL)(_pit("asof"))
query("point_in_time", "J2 J3", _PIT_SQL)(_pit("auto"))

_PIT_ITEMS = f"""WITH {o.PRICE_DIM}
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, r.o_orderdate, d.price_key, d.l_discount AS list_discount
FROM lineitem l JOIN orders r ON l.l_orderkey = r.o_orderkey
LEFT JOIN price_dim d ON l.l_partkey = d.l_partkey AND r.o_orderdate >= d.valid_from
  AND (r.o_orderdate < d.valid_to OR d.valid_to IS NULL)"""


_OFFERS = """offers AS (SELECT l_partkey, l_shipdate AS valid_from, l_discount AS offer,
  CASE WHEN l_returnflag <> 'A' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER) * 4) END AS valid_to FROM lineitem)"""


@query("point_in_time_overlap", "J2 J8", f"""WITH {_OFFERS}
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, r.o_orderdate, f.offer, f.valid_to AS ends
FROM lineitem l JOIN orders r ON l.l_orderkey = r.o_orderkey
LEFT JOIN offers f ON l.l_partkey = f.l_partkey AND r.o_orderdate >= f.valid_from AND (r.o_orderdate < f.valid_to OR f.valid_to IS NULL)""")
def _(spark, sf):
    """All offers of a part that stand at order time; their windows overlap, some never end."""
    ends = F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int") * 4)
    offers = lineitem(spark, sf).select(
        "l_partkey", F.col("l_shipdate").alias("valid_from"), F.col("l_discount").alias("offer"),
        F.when(F.col("l_returnflag") != "A", ends).alias("valid_to"),
    )
    return joins.point_in_time(
        _dated_items(spark, sf), offers, "l_partkey", "o_orderdate", "l_partkey", ["offer", "valid_to"],
        ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], disjoint=False, sizes=_part_rows(spark, sf),
    ).withColumnRenamed("valid_to", "ends")


def _dated_items(spark, sf) -> DataFrame:
    return lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").join(
        orders(spark, sf).select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    ).drop("o_orderkey")


def _part_rows(spark, sf) -> DataFrame:
    """Parts as often as lines and their versions or offers name them: one column, no join and no window."""
    parts = lineitem(spark, sf).select("l_partkey")
    return parts.union(parts)


def _pit_items(method: str):
    def run(spark, sf):
        dated = _dated_items(spark, sf)
        dim = price_dim(spark, sf).withColumnRenamed("l_discount", "list_discount")
        return joins.point_in_time(
            dated, dim, "l_partkey", "o_orderdate", "l_partkey", ["price_key", "list_discount"],
            ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], method, key_attribute="price_key", sizes=_part_rows(spark, sf),
        )

    return run


query("pit_items", "J8 J2", _PIT_ITEMS)(_pit_items("interval"))
query("asof_items", "J8 J3", _PIT_ITEMS)(_pit_items("asof"))


def bucketed_orders(spark, sf, buckets: int = 16) -> list[DataFrame]:
    found = []
    for name in ("stg_orders", "stg_order_items"):
        path = new_path(spark, name)
        found.append(changelog.bucketed(view(spark, sf, name), path.rsplit("/", 1)[1].replace("-", "_"), ["order_id"], buckets, path))
    return found


@query("orders_with_items", "J1 A1 F9", f"WITH {o.ORDERS_BASE} SELECT * FROM orders_base")
def _(spark, sf):
    return facts.orders_base(view(spark, sf, "stg_orders"), view(spark, sf, "stg_order_items"))


@query("orders_with_items_bucketed", "J1 K5", f"WITH {o.ORDERS_BASE} SELECT * FROM orders_base")
def _(spark, sf):
    """The same over tables in buckets by order: no exchange below the join."""
    return facts.orders_base(*bucketed_orders(spark, sf))


@query("order_summary", "A1", f"""WITH {o.ORDERS_BASE}
SELECT order_id, CAST(total_items AS BIGINT) AS total_items, total_quantity, calculated_item_total FROM summary""")
def _(spark, sf):
    return facts.order_summary(view(spark, sf, "stg_order_items"))


@query("resolved_facts", "J4", f"""WITH {o.USER_DIM}, {o.PURCHASES}, f AS ({o.PIT})
SELECT f.event_id, f.user_id, f.ts, f.user_key, d.event_type, d.is_current, d.valid_from
FROM f JOIN user_dim d ON f.user_key = d.user_key""")
def _(spark, sf):
    dim = user_dim(spark, sf)
    fact = joins.pit_join(roles.purchases(events(spark, sf)), dim, "user_id", "ts", "user_id", ["user_key"])
    return joins.resolve(
        fact.select("event_id", "user_id", "ts", "user_key"), dim, "user_key", ["event_type", "is_current", "valid_from"]
    )


@query("selected_orders", "P8 J4", f"""WITH {o.FACTS}
SELECT f.order_id, f.customer_id, f.customer_key, c.address, c.is_current, f.total_amount
FROM fct f JOIN dim_customers c ON f.customer_key = c.customer_key WHERE f.status IN ('delivered', 'shipped')""")
def _(spark, sf):
    dim = stored(customer_dim(spark, sf), "dim-customers")
    fct = facts.fct_orders(view(spark, sf, "stg_orders"), view(spark, sf, "stg_order_items"), dim)
    fct = fct.filter(F.col("status").isin("delivered", "shipped"))
    out = joins.resolve(fct, dim, "customer_key", ["address", "is_current"])
    return out.select("order_id", "customer_id", "customer_key", "address", "is_current", "total_amount")


@query("fk_violations", "J6 Q5 Q13", """
SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def _(spark, sf):
    """Orders of customers that are not in good standing."""
    return joins.fk_violations(orders(spark, sf), customer(spark, sf).filter("c_acctbal >= 0"), "o_custkey", "c_custkey")


# facts and marts --------------------------------------------------------------

query("fct_orders", "D7 A1 J1 J2", f"WITH {o.FACTS} SELECT * FROM fct")(order_facts)


@query("fct_orders_asof", "D7 J3", f"WITH {o.FACTS} SELECT * FROM fct")
def _(spark, sf):
    return order_facts(spark, sf, "asof")


@query("fct_order_items", "J8", f"""WITH {o.PRODUCT_DIM}, {o.ORDERS_BASE}
SELECT i.order_item_id, i.order_id, p.product_key, i.product_id, r.customer_id, r.order_date, r.status, i.quantity,
       i.unit_price, i.item_subtotal
FROM stg_items i LEFT JOIN stg_orders r ON i.order_id = r.order_id
LEFT JOIN dim_products p ON i.product_id = p.product_id AND r.order_date >= p.valid_from
  AND (r.order_date < p.valid_to OR p.valid_to IS NULL)""")
def _(spark, sf):
    """Dated items are stored, and the shuffles before them dropped; versions are made where they meet their items."""
    dated = facts.dated_items(view(spark, sf, "stg_order_items").drop("captured_at"), view(spark, sf, "stg_orders"))
    with shuffles_dropped(spark):
        dated = stored(dated, "dated-items", compression="zstd")
    sold = lineitem(spark, sf).select(F.col("l_partkey").alias("product_id"))
    events = sold.union(part(spark, sf).select("p_partkey"))
    dim = scd2.dim_products_scd2(view(spark, sf, "stg_products").drop("operation", "updated_at"), sizes=events)
    return facts.keyed_items(dated, dim, sizes=sold.union(events), widths=events)


@query("daily_sales", "A7 A2 A3 A4 A5 A6 F7 F8 F9 F10 F18 P2", f"WITH {o.DAILY_ALL} SELECT * FROM daily")
def _(spark, sf):
    return marts.daily_sales(order_facts(spark, sf))


@query("item_reconciliation", "A15", f"""WITH {o.ORDERS_BASE}, gaps AS (
  SELECT b.order_id, b.total_amount, coalesce(s.calculated_item_total, 0.0) AS calculated_item_total,
         {o.cents('b.total_amount')} - {o.cents('coalesce(s.calculated_item_total, 0.0)')} AS gap
  FROM stg_orders b LEFT JOIN summary s ON b.order_id = s.order_id)
SELECT order_id, total_amount, calculated_item_total, {o.money('gap')} AS difference FROM gaps WHERE abs(gap) > 0""")
def _(spark, sf):
    return facts.reconcile(view(spark, sf, "stg_orders"), view(spark, sf, "stg_order_items"))


@query("kpis", "A9 A10", f"""WITH {o.FACTS}, sums AS (
  SELECT count(*) AS total_orders, CAST(sum({o.cents('total_amount')}) AS BIGINT) AS revenue,
         CAST(sum(total_items) AS BIGINT) AS total_items, CAST(sum(total_quantity) AS BIGINT) AS total_quantity,
         count(DISTINCT customer_id) AS distinct_customers FROM fct)
SELECT total_orders, {o.money('revenue')} AS total_revenue, {o.money(o.half_up('revenue', 'total_orders'))} AS aov,
       total_items, total_quantity, distinct_customers FROM sums""")
def _(spark, sf):
    return marts.kpis(order_facts(spark, sf))


@query("distinct_customers_by_sketch", "A10", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, TRUE AS within_bound FROM orders GROUP BY o_orderpriority
UNION ALL SELECT NULL, count(DISTINCT o_custkey), TRUE FROM orders""")
def _(spark, sf):
    """Stored sketches per (day, priority), merged to priorities and to one total, beside the exact counts; bound: four standard errors."""
    rows = orders(spark, sf)
    sketches = stored(marts.distinct_sketches(rows, ["o_orderdate", "o_orderpriority"], "o_custkey"), "sketches")
    exact = F.count_distinct("o_custkey").alias("customers")
    by = rows.groupBy("o_orderpriority").agg(exact).join(
        marts.distinct_estimates(sketches, ["o_orderpriority"]).withColumnRenamed("o_orderpriority", "_p"),
        F.col("o_orderpriority").eqNullSafe(F.col("_p")),
    ).drop("_p")
    total = rows.agg(exact).join(marts.distinct_estimates(sketches, []), how="cross")  # one row each
    both = by.unionByName(total.withColumn("o_orderpriority", F.lit(None).cast("string")))
    close = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), F.col("customers") * (4 * 1.04 / 64))
    return both.select("o_orderpriority", "customers", close.alias("within_bound"))


@query("status_breakdown", "A11 A12", f"""WITH {o.FACTS}, g AS (
  SELECT status, count(*) AS n, CAST(sum({o.cents('total_amount')}) AS BIGINT) AS revenue FROM fct GROUP BY status),
t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM g)
SELECT status, n AS count, {o.money('revenue')} AS revenue,
       CAST({o.half_up('n * 1000', '(SELECT total FROM t)')} AS DOUBLE) / 10.0 AS share_pct FROM g""")
def _(spark, sf):
    return marts.status_breakdown(order_facts(spark, sf))


@query("conditional_aggregates", "A2 A3 A4 A6 F10 F11", f"""
WITH g AS (
  SELECT o_custkey, count(*) AS orders,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {o.cents('o_totalprice')} ELSE 0 END) AS BIGINT) AS closed,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS closed_orders,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN {o.cents('o_totalprice')} END) AS BIGINT) AS urgent,
    count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent_orders
  FROM orders GROUP BY o_custkey)
SELECT o_custkey, orders, {o.money('closed')} AS closed_value, closed_orders,
       {o.money(o.half_up('urgent', 'urgent_orders'))} AS urgent_mean,
       {o.money(o.half_up('closed_orders * 10000', 'orders'))} AS closed_pct,
       {o.money(o.half_up('urgent_orders * 10000', 'closed_orders'))} AS urgent_per_closed_pct FROM g""")
def _(spark, sf):
    closed, urgent = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    price = F.col("o_totalprice")
    return orders(spark, sf).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), sum_money_if(closed, price).alias("closed_value"),
        count_if(closed).alias("closed_orders"), avg_if(urgent, price).alias("urgent_mean"),
        percent(count_if(closed), F.count(F.lit(1))).alias("closed_pct"),
        percent(count_if(urgent), count_if(closed)).alias("urgent_per_closed_pct"),
    )


@query("row_counts", "A13 S6 P3 U1", """
SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM orders
UNION ALL SELECT 'lineitem', CAST(count(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'customer', CAST(count(*) AS BIGINT) FROM customer
UNION ALL SELECT 'part', CAST(count(*) AS BIGINT) FROM part
UNION ALL SELECT 'no_such_table', CAST(0 AS BIGINT)""")
def _(spark, sf):
    return marts.row_counts({
        "orders": orders(spark, sf), "lineitem": lineitem(spark, sf), "customer": customer(spark, sf),
        "part": part(spark, sf), "no_such_table": changelog.read_table(spark, "no_such_table"),
    })


@query("source_stats", "A14", """
SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS unprocessed FROM customer
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), NULL FROM orders
UNION ALL SELECT 'change_log', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) FROM events""")
def _(spark, sf):
    log = events(spark, sf).withColumn("processed", F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return marts.source_stats({"customer": customer(spark, sf), "orders": orders(spark, sf)}, log)


_DAYS = """strftime(sale_date, '%Y-%m-%d') AS sale_date, total_orders, gross_revenue, delivered_revenue,
  delivered_orders, average_order_value, cancellation_rate_pct"""


@query("top_days", "O1 O2 F12", f"WITH {o.DAILY_ALL} SELECT {_DAYS} FROM daily ORDER BY daily.sale_date DESC LIMIT 6")
def _(spark, sf):
    days = marts.latest_days(marts.daily_sales(order_facts(spark, sf)), 6)
    return days.select(
        fmt_ts(F.col("sale_date"), "yyyy-MM-dd").alias("sale_date"), "total_orders", "gross_revenue",
        "delivered_revenue", "delivered_orders", "average_order_value", "cancellation_rate_pct",
    )


@query("latest_orders", "O3", f"WITH {o.FACTS} SELECT * FROM fct ORDER BY order_date DESC, order_id DESC LIMIT 5")
def _(spark, sf):
    return marts.latest_orders(order_facts(spark, sf), 5)


@query("first_versions", "O4", f"""WITH {o.CUSTOMER_DIM}
SELECT customer_key, customer_id, name, address, is_current, valid_from, valid_to FROM dim_customers
ORDER BY customer_id, customer_key LIMIT 5""")
def _(spark, sf):
    rows = marts.first_versions(customer_dim(spark, sf), 5, ["customer_id", "customer_key"])
    return rows.select("customer_key", "customer_id", "name", "address", "is_current", "valid_from", "valid_to")


# quality ----------------------------------------------------------------------


@query("range_violations", "Q2 Q13 P6", "SELECT * FROM customer WHERE c_acctbal < 0")
def _(spark, sf):
    return quality.violations(customer(spark, sf), quality.Between("c_acctbal", 0))


@query("set_violations", "Q3 Q13", "SELECT * FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(spark, sf):
    return quality.violations(orders(spark, sf), quality.InSet("o_orderstatus", ("F", "O")))


@query("regex_violations", "Q4 F15", "SELECT * FROM part WHERE NOT regexp_matches(p_name, 'e')")
def _(spark, sf):
    return quality.violations(part(spark, sf), quality.Matches("p_name", "e"))


@query("null_violations", "Q1 P5", "SELECT * FROM customer WHERE c_custkey IS NULL OR c_custkey = 0")
def _(spark, sf):
    return quality.violations(customer(spark, sf), quality.NotNull("c_custkey", reject_zero=True))


@query("unique_violations", "Q6", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    rows = lineitem(spark, sf).select(F.struct("l_orderkey", "l_linenumber").alias("line"))
    return quality.not_unique(rows, "line").select("line.*", "copies")


def _numeric(column: str) -> str:
    return f"{column} IS NOT NULL AND {column} < 0"


@query("source_suite", "Q11 Q14 Q15 Q16 Q1 Q2 Q3 Q4 Q5", """
WITH r AS (
  SELECT 'products' AS suite, 'not_null' AS expectation, 'product_id' AS "column", (SELECT count(*) FROM part) + (SELECT count(*) FROM lineitem) AS evaluated,
         (SELECT count(*) FROM part WHERE p_partkey = 0) + (SELECT count(*) FROM lineitem WHERE l_partkey = 0) AS violations
  UNION ALL SELECT 'products', 'between', 'price', (SELECT count(*) FROM part) + (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM part WHERE p_retailprice <= 0) + (SELECT count(*) FROM lineitem WHERE l_tax = 0 OR l_discount <= 0)
  UNION ALL SELECT 'products', 'not_null', 'name', (SELECT count(*) FROM part) + (SELECT count(*) FROM lineitem), 0
  UNION ALL SELECT 'customers', 'not_null', 'customer_id', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders),
         (SELECT count(*) FROM customer WHERE c_custkey = 0) + (SELECT count(*) FROM orders WHERE o_custkey = 0)
  UNION ALL SELECT 'customers', 'matches', 'email', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'orders', 'not_null', 'order_id', 2 * (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'orders', 'not_null', 'customer_id', 2 * (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'orders', 'in_set', 'status', 2 * (SELECT count(*) FROM orders),
         (SELECT count(*) FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'))
  UNION ALL SELECT 'orders', 'between', 'total_amount', 2 * (SELECT count(*) FROM orders), 2 * (SELECT count(*) FROM orders WHERE o_totalprice < 0)
  UNION ALL SELECT 'orders', 'references', 'customer_id', 2 * (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'inventory', 'between', 'stock_level', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_quantity < 0)
  UNION ALL SELECT 'order_items', 'between', 'quantity', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_tax = 0 OR l_quantity <= 0)
  UNION ALL SELECT 'order_items', 'references', 'product_id', (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part UNION SELECT l_partkey FROM lineitem)))
SELECT suite, expectation, "column", CAST(evaluated AS BIGINT) AS evaluated, CAST(violations AS BIGINT) AS violations,
       violations = 0 AS success FROM r""")
def _(spark, sf):
    return retail.source_quality(roles.retail_log(spark, sf), retail.ALL_SUITES)


@query("suite_on_tables", "Q11 Q6 J6", """
WITH r AS (
  SELECT 'orders' AS suite, 'in_set' AS expectation, 'o_orderstatus' AS "column", count(*) AS evaluated,
         count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders
  UNION ALL SELECT 'orders', 'unique', 'o_custkey', count(*), (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) FROM orders
  UNION ALL SELECT 'orders', 'references', 'o_custkey', count(*), count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) FROM orders
  UNION ALL SELECT 'customer', 'between', 'c_acctbal', count(*), count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 5000) FROM customer
  UNION ALL SELECT 'customer', 'unique', 'c_custkey', count(*), 0 FROM customer)
SELECT suite, expectation, "column", CAST(evaluated AS BIGINT) AS evaluated, CAST(violations AS BIGINT) AS violations,
       violations = 0 AS success FROM r""")
def _(spark, sf):
    tables = {
        "orders": orders(spark, sf), "customer": customer(spark, sf),
        "good_customers": customer(spark, sf).filter("c_acctbal >= 0"),
    }
    return quality.run_suite(tables, {
        "orders": [
            quality.InSet("o_orderstatus", ("F", "O")), quality.Unique("o_custkey"),
            quality.References("o_custkey", "good_customers", "c_custkey"),
        ],
        "customer": [quality.Between("c_acctbal", 0, 5000), quality.Unique("c_custkey")],
    })


@query("model_suite", "Q11 Q1 Q3 Q6", f"""WITH {o.DAILY_ALL},
dup AS (SELECT count(*) AS n FROM (SELECT customer_key FROM dim_customers GROUP BY 1 HAVING count(*) > 1)),
r AS (
  SELECT 'stg_orders' AS suite, 'not_null' AS expectation, 'order_id' AS "column", (SELECT count(*) FROM orders) AS evaluated, 0 AS violations
  UNION ALL SELECT 'stg_orders', 'not_null', 'customer_id', (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'stg_orders', 'in_set', 'status', (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'stg_orders', 'unique', 'order_id', (SELECT count(*) FROM orders), 0
  UNION ALL SELECT 'dim_customers_scd2', 'not_null', 'customer_key', (SELECT count(*) FROM dim_customers), 0
  UNION ALL SELECT 'dim_customers_scd2', 'not_null', 'customer_id', (SELECT count(*) FROM dim_customers), 0
  UNION ALL SELECT 'dim_customers_scd2', 'not_null', 'is_current', (SELECT count(*) FROM dim_customers), 0
  UNION ALL SELECT 'dim_customers_scd2', 'unique', 'customer_key', (SELECT count(*) FROM dim_customers), (SELECT n FROM dup)
  UNION ALL SELECT 'fct_orders', 'not_null', 'order_id', (SELECT count(*) FROM fct), 0
  UNION ALL SELECT 'fct_orders', 'not_null', 'customer_id', (SELECT count(*) FROM fct), 0
  UNION ALL SELECT 'fct_orders', 'not_null', 'total_amount', (SELECT count(*) FROM fct), 0
  UNION ALL SELECT 'fct_orders', 'unique', 'order_id', (SELECT count(*) FROM fct), 0
  UNION ALL SELECT 'agg_daily_sales', 'not_null', 'sale_date', (SELECT count(*) FROM daily), 0
  UNION ALL SELECT 'agg_daily_sales', 'not_null', 'total_orders', (SELECT count(*) FROM daily), 0
  UNION ALL SELECT 'agg_daily_sales', 'unique', 'sale_date', (SELECT count(*) FROM daily), 0)
SELECT suite, expectation, "column", CAST(evaluated AS BIGINT) AS evaluated, CAST(violations AS BIGINT) AS violations,
       violations = 0 AS success FROM r""")
def _(spark, sf):
    """The checks on the order models, over stored tables."""
    path = new_path(spark, "models")
    tables = {"stg_orders": changelog.refresh(view(spark, sf, "stg_orders"), f"{path}/orders")}
    tables["dim_customers_scd2"] = changelog.refresh(customer_dim(spark, sf), f"{path}/dim")
    tables["fct_orders"] = changelog.refresh(
        facts.fct_orders(
            tables["stg_orders"], view(spark, sf, "stg_order_items"), tables["dim_customers_scd2"]
        ),
        f"{path}/fct",
    )
    tables["agg_daily_sales"] = marts.daily_sales(tables["fct_orders"])
    return quality.run_suite(tables, {name: quality.MODEL_SUITES[name] for name in tables})


@query("quarantine", "Q13 Q12 T3", """
SELECT o_orderkey, o_custkey, o_orderstatus, array_to_string(failed_list, ', ') AS reasons, len(failed_list) AS failed
FROM (SELECT *, list_filter([
        CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'in_set(o_orderstatus)' END,
        CASE WHEN o_totalprice > 250000 THEN 'between(o_totalprice)' END,
        CASE WHEN c_custkey IS NULL THEN 'references(o_custkey)' END], lambda x: x IS NOT NULL) AS failed_list
      FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey)""")
def _(spark, sf):
    """Both sides of the split, so that no row is lost."""
    rules = [
        quality.InSet("o_orderstatus", ("F", "O")), quality.Between("o_totalprice", max_value=250000),
        quality.References("o_custkey", "customers", "c_custkey"),
    ]
    parents = {"customers": customer(spark, sf).filter("c_acctbal >= 0")}
    clean, bad = quality.quarantine(orders(spark, sf), rules, parents)
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    return clean.select(*columns, F.lit("").alias("reasons"), F.lit(0).cast("bigint").alias("failed")).unionByName(
        bad.select(
            *columns, F.array_join(quality.FAILED, ", ").alias("reasons"),
            F.size(quality.FAILED).cast("bigint").alias("failed"),
        )
    )


@query("quality_gate", "Q12", """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS bad FROM orders)
SELECT 'open' AS run, TRUE AS passed, '' AS told FROM n
UNION ALL SELECT 'closed', bad = 0, CASE WHEN bad = 0 THEN '' ELSE 'orders.o_orderstatus in_set: ' || bad || ' of ' || n END FROM n""")
def _(spark, sf):
    """A gate that opens and one that does not."""
    lines = []
    for run, states in (("open", ("F", "O", "P")), ("closed", ("F", "O"))):
        suites = {"orders": [quality.NotNull("o_orderkey"), quality.InSet("o_orderstatus", states), quality.Unique("o_orderkey")]}
        try:
            quality.gate(quality.run_suite({"orders": orders(spark, sf)}, suites))
            lines.append((run, True, ""))
        except quality.GateClosed as told:
            lines.append((run, False, str(told)))
    return spark.createDataFrame(lines, "run string, passed boolean, told string")


# Suites as files declare them.
_DECLARED = """{"expectations": [
  {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"table": "orders", "column": "o_custkey"}},
  {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"table": "customer", "column": "c_acctbal", "min_value": 0, "max_value": 5000}},
  {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"table": "customer", "column": "c_name", "regex": "7$"}}]}"""
_DECLARED_MODELS = """{"models": [{"name": "orders", "columns": [
  {"name": "o_orderkey", "tests": ["unique", "not_null"]}, {"name": "o_comment"},
  {"name": "o_orderstatus", "tests": [{"accepted_values": {"values": ["F", "O"]}}]}]}]}"""


@query("declared_suites", "Q14 Q11", """
WITH r AS (
  SELECT 'orders' AS suite, 'unique' AS expectation, 'o_custkey' AS "column", count(*) AS evaluated,
         (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)) AS violations FROM orders
  UNION ALL SELECT 'customer', 'between', 'c_acctbal', count(*), count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 5000) FROM customer
  UNION ALL SELECT 'customer', 'matches', 'c_name', count(*), count(*) FILTER (c_name NOT LIKE '%7') FROM customer
  UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*), count(*) - count(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'orders', 'not_null', 'o_orderkey', count(*), count(*) - count(o_orderkey) FROM orders
  UNION ALL SELECT 'orders', 'in_set', 'o_orderstatus', count(*), count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders)
SELECT suite, expectation, "column", CAST(evaluated AS BIGINT) AS evaluated, CAST(violations AS BIGINT) AS violations,
       violations = 0 AS success FROM r""")
def _(spark, sf):
    suites = quality.merge_suites(quality.load_suite(_DECLARED), quality.load_model_tests(json.loads(_DECLARED_MODELS)))
    return quality.run_suite({"orders": orders(spark, sf), "customer": customer(spark, sf)}, suites)


@query("load_quarantine", "G6 Q13 E10 E2", """
WITH e AS (
  SELECT 'orders' AS "table", 'unreadable' AS cause, 'total_amount' AS "column", count(*) AS n FROM orders WHERE o_orderkey % 13 = 0
  UNION ALL SELECT 'orders', 'unknown', 'operation', count(*) FROM orders WHERE o_orderkey % 17 = 0
  UNION ALL SELECT 'orders', 'unreadable', 'captured_at', count(*) FROM orders WHERE o_orderkey % 19 = 0
  UNION ALL SELECT NULL, 'malformed', NULL, count(*) FROM orders WHERE o_orderkey % 23 = 0
  UNION ALL SELECT 'orders', 'loaded', NULL, count(*) FROM orders WHERE o_orderkey % 13 > 0 AND o_orderkey % 17 > 0 AND o_orderkey % 19 > 0)
SELECT "table", cause, "column", CAST(n AS BIGINT) AS events FROM e WHERE n > 0""")
def _(spark, sf):
    """The order log with broken values, operations and stamps, and cut connector messages: every row is loaded or told."""
    key = F.col("change_id") / 2
    log = roles.retail_log(spark, sf, "orders").filter("change_id % 2 = 0").withColumn("_corrupt_record", F.lit(None).cast("string"))
    broken = log.withColumns({
        "after": F.when(key % 13 == 0, F.map_concat(F.map_filter("after", lambda k, v: k != "total_amount"), F.create_map(F.lit("total_amount"), F.lit("n/a")))).otherwise(F.col("after")),
        "operation": F.when(key % 17 == 0, "merge").otherwise(F.col("operation")),
        "captured_at": F.when(key % 19 == 0, "yesterday").otherwise(F.col("captured_at")),
    })
    cut = orders(spark, sf).filter("o_orderkey % 23 = 0").select(F.format_string('{"op": "c", "after": {"id": "%d"', "o_orderkey").alias("value"))
    both = broken.unionByName(envelope.from_connector(cut, keep_malformed=True).select(*broken.columns))
    loaded = retail.load_log(both, new_path(spark, "load"), {"orders": [quality.NotNull("order_id")]})
    counts = loaded.good.groupBy("table").agg(F.count(F.lit(1)).alias("events"))
    return error_counts(loaded.bad).unionByName(counts.withColumns({"cause": F.lit("loaded"), "column": F.lit(None).cast("string")}))


@query("validation_view", "Q16", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'pending' AS status, 'insert' AS _operation FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN ' shipped'
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'cancelled' ELSE 'PENDING ' END, 'u' FROM orders""")
def _(spark, sf):
    rows = envelope.validation_view(roles.retail_log(spark, sf, "orders"), "orders", ["order_id", "status"])
    return rows.select("order_id", "status", "_operation")


@query("one_current", "Q7 A8 U1 P3", f"""WITH {o.USER_DIM}, {o.PRICE_DIM}
SELECT 'prices' AS entity_type, l_partkey AS entity_id, CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_rows
FROM price_dim GROUP BY l_partkey HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) <> 1
UNION ALL SELECT 'users', user_id, CAST(sum(CASE WHEN is_current AND event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT)
FROM user_dim GROUP BY user_id HAVING sum(CASE WHEN is_current AND event_type <> 'error' THEN 1 ELSE 0 END) <> 1""")
def _(spark, sf):
    """Users whose newest state is an error count as having no current version."""
    users = user_dim(spark, sf).withColumn("is_current", F.col("is_current") & (F.col("event_type") != "error"))
    return diff.union_findings(
        quality.one_current(price_dim(spark, sf), "l_partkey", "prices"), quality.one_current(users, "user_id", "users")
    )


@query("one_current_strict", "Q8", f"""WITH {o.PRICE_DIM}, two AS (
  SELECT l_partkey, is_current FROM price_dim UNION ALL SELECT l_partkey, is_current FROM price_dim WHERE l_returnflag = 'R')
SELECT 'prices' AS entity_type, l_partkey AS entity_id, CAST(count(*) AS BIGINT) AS current_rows
FROM two WHERE is_current GROUP BY l_partkey HAVING count(*) <> 1""")
def _(spark, sf):
    """A dimension that was loaded twice for returned parts."""
    dim = price_dim(spark, sf).select("l_partkey", "is_current", "l_returnflag")
    twice = dim.unionByName(dim.filter("l_returnflag = 'R'"))
    return quality.one_current_strict(twice, "l_partkey", "prices")


@query("valid_windows", "Q9 U1 P3 P5 P6", f"""WITH {o.USER_DIM}, {o.PRICE_DIM}
SELECT 'prices' AS entity_type, l_partkey AS entity_id, valid_from, valid_to FROM price_dim WHERE valid_to IS NOT NULL AND valid_to <= valid_from
UNION ALL SELECT 'users', user_id, valid_from, valid_to FROM user_dim WHERE valid_to IS NOT NULL AND valid_to <= valid_from""")
def _(spark, sf):
    return diff.union_findings(
        quality.valid_windows(price_dim(spark, sf), "l_partkey", "prices"),
        quality.valid_windows(user_dim(spark, sf), "user_id", "users"),
    )


@query("no_overlap", "Q10", f"""WITH {o.PRICE_DIM}, moved AS (
  SELECT l_partkey, valid_from, CASE l_returnflag WHEN 'R' THEN valid_to + INTERVAL 10 DAY WHEN 'A' THEN valid_to - INTERVAL 1 HOUR ELSE valid_to END AS valid_to,
         price_key, l_discount FROM price_dim),
n AS (SELECT *, lead(valid_from) OVER (PARTITION BY l_partkey ORDER BY valid_from, valid_to NULLS LAST, price_key, l_discount) AS next_from FROM moved)
SELECT 'prices' AS entity_type, l_partkey AS entity_id, valid_from, valid_to, next_from,
       CASE WHEN valid_to IS NULL OR next_from < valid_to THEN 'overlap' ELSE 'gap' END AS finding
FROM n WHERE next_from IS NOT NULL AND (valid_to IS NULL OR next_from <> valid_to)""")
def _(spark, sf):
    """Windows of returned parts end ten days late, of accepted ones an hour early."""
    flag, end = F.col("l_returnflag"), F.col("valid_to")
    moved = (
        F.when(flag == "R", end + F.make_dt_interval(days=F.lit(10)))
        .when(flag == "A", end - F.make_dt_interval(hours=F.lit(1)))
        .otherwise(end)
    )
    dim = price_dim(spark, sf).withColumn("valid_to", moved)
    return quality.no_overlap(dim, "l_partkey", "prices", ["price_key", "l_discount"])


# runs and streams -------------------------------------------------------------


@query("history_proof", "X2", f"""
WITH early AS (SELECT * FROM events WHERE event_id % 4 < 3), {o.scd2("early", "was", "user_id", ["event_type"], [], "ts", ["event_id"], "user_key")},
{o.USER_DIM_ALL}
SELECT user_id, CAST(count(*) FILTER (side = 0) AS BIGINT) AS versions_before, CAST(count(*) FILTER (side = 1) AS BIGINT) AS versions_after,
       CAST(count(*) FILTER (side = 0 AND NOT kept) AS BIGINT) AS lost
FROM (SELECT user_id, 0 AS side, EXISTS (FROM user_dim d WHERE d.user_id = was.user_id AND d.valid_from = was.valid_from AND d.event_type = was.event_type
        AND (was.valid_to IS NULL OR was.valid_to = d.valid_to)) AS kept FROM was
      UNION ALL SELECT user_id, 1, TRUE FROM user_dim) GROUP BY user_id""")
def _(spark, sf):
    """Version chains before and after the last quarter of the events, which comes in between the others."""
    log = events(spark, sf)
    before, after = scd2.scd2(log.filter("event_id % 4 < 3"), roles.USERS), scd2.scd2(log, roles.USERS)
    return retail.history_kept(before, after, ["user_id"], ["event_type"])


@query("idempotent_rebuild", "X1 U2", f"""WITH {o.DAILY_ALL}
SELECT CAST(count(*) AS BIGINT) AS days, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right FROM daily""")
def _(spark, sf):
    """The daily mart written twice from the same log."""
    path = new_path(spark, "rebuild")
    first = changelog.refresh(marts.daily_sales(order_facts(spark, sf)), f"{path}/first")
    second = changelog.refresh(marts.daily_sales(order_facts(spark, sf)), f"{path}/second")
    counts = diff.diff_counts(first, second)
    return first.agg(F.count(F.lit(1)).alias("days")).withColumns(
        {c: counts.select(c).scalar() for c in ("only_left", "only_right")}
    )


@query("diff_runs", "U2", """
WITH a AS (SELECT o_custkey, o_orderstatus FROM orders), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice < 300000)
SELECT o_custkey, o_orderstatus, CAST(sum(s) AS BIGINT) AS surplus FROM (
  SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL HAVING sum(s) <> 0""")
def _(spark, sf):
    rows = orders(spark, sf)
    columns = ["o_custkey", "o_orderstatus"]
    return diff.diff_runs(rows.select(*columns), rows.filter("o_totalprice < 300000").select(*columns))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table, a file or a folder of part files, as a stream."""
    reader = spark.readStream.schema(events(spark, sf).schema)
    if changelog.is_folder(spark, f"{sf}/events.parquet"):
        return reader.parquet(f"{sf}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf)


def _finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()


@query("stream_ingest", "T1 K1 S5", f"""
WITH {o.CHANGES}
SELECT "table", CAST(ts AS DATE) AS event_date, operation, CAST(count(*) AS BIGINT) AS events FROM changes GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "stream-ingest")
    source = roles.events_json(event_stream(spark, sf))
    _finish(*ingest_stream(source, f"{path}/bronze", f"{path}/checkpoint", f"{path}/quarantine", trigger=ONCE))
    return changelog.read_changes(spark, f"{path}/bronze").groupBy("table", "event_date", "operation").agg(
        F.count(F.lit(1)).alias("events")
    )


def _grow(lines: DataFrame, folder: str, deliveries: int) -> None:
    """Stands in for the capture process: each file is written anew with the lines of the first ``deliveries``, so a retry changes nothing."""

    def write(rows) -> None:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/changes-{TaskContext.get().partitionId()}.jsonl") as out:
            for row in rows:
                out.write(row["value"].encode() + b"\n")

    known = lines.filter(F.col("delivery") < deliveries).repartition(4, "key")
    known.sortWithinPartitions("delivery", "key").foreachPartition(write)


@query("growing_files", "S1 S3 T1", f"""
WITH {o.CHANGES}
SELECT "table", operation, user_id, event_type, value, ts AS captured_at, change_id FROM changes""")
def _(spark, sf):
    """Files that grow twice after they were read; every line arrives once."""
    path = new_path(spark, "growing")
    lines = roles.events_envelope(events(spark, sf)).select(
        F.to_json(F.struct("*")).alias("value"), F.col("change_id").alias("key"), (F.col("change_id") % 3).alias("delivery")
    )
    for deliveries in (1, 2, 3):
        _grow(lines, f"{path}/log", deliveries)
        source = read_growing(spark, f"{path}/log", pieceBytes=str(1 << 20))
        _finish(*ingest_stream(source, f"{path}/bronze", f"{path}/checkpoint", f"{path}/quarantine", trigger=ONCE))
    image = F.col("payload")
    return envelope.payload(changelog.read_changes(spark, f"{path}/bronze")).select(
        "table", "operation", field(image, "user_id").cast("bigint").alias("user_id"),
        field(image, "type").alias("event_type"), to_double(field(image, "value")).alias("value"),
        parse_ts(F.col("captured_at")).alias("captured_at"), "change_id",
    )


@query("bronze_stream_then_batch", "T1 K1 S1", f"""
WITH {o.CHANGES}
SELECT "table", operation, CAST(2 * count(*) AS BIGINT) AS events FROM changes GROUP BY ALL""")
def _(spark, sf):
    """A stream and a batch write to one bronze folder; both are read back."""
    path = new_path(spark, "bronze-both")
    source = roles.events_json(event_stream(spark, sf))
    _finish(*ingest_stream(source, f"{path}/bronze", f"{path}/checkpoint", f"{path}/quarantine", trigger=ONCE))
    log = roles.events_envelope(events(spark, sf)).withColumn("operation", envelope.normalize_op(F.col("operation")))
    changelog.write_bronze(log, f"{path}/bronze")
    return changelog.read_changes(spark, f"{path}/bronze").groupBy("table", "operation").agg(F.count(F.lit(1)).alias("events"))


@query("stream_dedupe", "T2", f"""
WITH {o.CHANGES}
SELECT "table", CAST(count(*) AS BIGINT) AS events, CAST(sum(change_id) AS BIGINT) AS id_sum FROM changes GROUP BY "table" """)
def _(spark, sf):
    """The stream joined with itself: every event is delivered twice."""
    path = new_path(spark, "stream-dedupe")
    log = roles.events_envelope(event_stream(spark, sf))
    twice = log.unionByName(roles.events_envelope(event_stream(spark, sf)))
    q = dedupe_stream(twice, "40 days").select("table", "change_id").writeStream.format("parquet").option(
        "path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(**ONCE).start()
    _finish(q)
    return spark.read.parquet(f"{path}/out").groupBy("table").agg(
        F.count(F.lit(1)).alias("events"), F.sum("change_id").alias("id_sum")
    )


@query("stream_dedupe_late", "T2 T5", f"""
WITH {o.CHANGES}
SELECT "table", CAST(count(*) AS BIGINT) AS events, CAST(sum(change_id) AS BIGINT) AS id_sum FROM changes GROUP BY "table" """)
def _(spark, sf):
    """Most events first, then all of them again: repetitions and news, nearly all later than the state is kept."""
    path = new_path(spark, "stream-dedupe-late")
    log = roles.events_envelope(events(spark, sf))
    log.filter("change_id % 10 <> 7").write.parquet(f"{path}/in")
    for delivery in (1, 2):
        stream = spark.readStream.schema(ENVELOPE).parquet(f"{path}/in")
        _finish(start_deduped(stream, "1 day", f"{path}/bronze", f"{path}/checkpoint", ONCE))
        if delivery == 1:
            log.write.mode("append").parquet(f"{path}/in")
    return changelog.read_changes(spark, f"{path}/bronze").groupBy("table").agg(
        F.count(F.lit(1)).alias("events"), F.sum("change_id").alias("id_sum")
    )


@query("stream_append_new", "T2 T5", f"""
WITH {o.CHANGES}
SELECT "table", CAST(count(*) AS BIGINT) AS events, CAST(sum(change_id) AS BIGINT) AS id_sum FROM changes GROUP BY "table" """)
def _(spark, sf):
    """The whole log delivered in two streams: nothing is stored twice."""
    path = new_path(spark, "stream-append")
    for delivery in (1, 2):
        log = roles.events_envelope(event_stream(spark, sf))
        batch = append_new(f"{path}/bronze")
        q = log.writeStream.option("checkpointLocation", f"{path}/checkpoint-{delivery}").foreachBatch(
            lambda df, n, d=delivery, run=batch: run(df, n + 1000 * d)).trigger(**ONCE).start()
        _finish(q)
    return changelog.read_changes(spark, f"{path}/bronze").groupBy("table").agg(
        F.count(F.lit(1)).alias("events"), F.sum("change_id").alias("id_sum")
    )


@query("stream_gate", "T3 Q13", """
SELECT event_type IN ('signup', 'view', 'click') AND value <= 200 AS accepted, event_type, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "stream-gate")
    rules = [quality.InSet("event_type", ("signup", "view", "click")), quality.Between("value", max_value=200)]
    q = event_stream(spark, sf).writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(
        gate_batch(rules, f"{path}/accepted", f"{path}/rejected")).trigger(**ONCE).start()
    _finish(q)
    sides = [
        spark.read.parquet(f"{path}/{name}").select(F.lit(name == "accepted").alias("accepted"), "event_type")
        for name in ("accepted", "rejected")
    ]
    return diff.union_findings(*sides).groupBy("accepted", "event_type").agg(F.count(F.lit(1)).alias("events"))


def _as_orders(rows: DataFrame) -> DataFrame:
    """Events as append-only order facts."""
    status = F.when(F.col("event_type") == "purchase", "delivered").when(F.col("event_type") == "error", "cancelled")
    return rows.select(
        F.col("event_id").alias("order_id"), F.col("ts").alias("order_date"),
        F.coalesce(status, F.lit("pending")).alias("status"), F.col("value").alias("total_amount"),
        F.lit(1).cast("bigint").alias("total_quantity"),
    )


@query("stream_daily", "T6 A7", f"""
WITH fct AS (SELECT event_id AS order_id, ts AS order_date, value AS total_amount, 1 AS total_quantity,
  CASE event_type WHEN 'purchase' THEN 'delivered' WHEN 'error' THEN 'cancelled' ELSE 'pending' END AS status FROM events),
{o.DAILY} SELECT * FROM daily""")
def _(spark, sf):
    path = new_path(spark, "stream-daily")
    stream = daily_sales_stream(_as_orders(event_stream(spark, sf)))
    _finish(start_windows(stream, f"{path}/out", f"{path}/checkpoint", ONCE))
    return read_windows(spark, f"{path}/out")


def _deliveries(spark: SparkSession, sf: str) -> list[str]:
    """The retail log as two deliveries; the second one brings late changes."""
    path = new_path(spark, "retail-log")
    changed = F.col("table").isin("customers", "orders", "order_items") & F.col("operation").isin("update", "u", "delete")
    log = roles.retail_log(spark, sf).withColumn("delivery", F.when(changed, 1).otherwise(0))
    log.write.option("compression", "zstd").partitionBy("delivery").parquet(path)
    return [f"{path}/delivery={n}" for n in (0, 1)]


@query("stream_maintain", "T4 T5 D8 A7", f"WITH {o.DAILY_ALL} SELECT * FROM daily")
def _(spark, sf):
    """Two micro-batches with late changes give the mart of the full build."""
    path = new_path(spark, "warehouse")
    warehouse = IncrementalWarehouse(spark, path)
    for n, source in enumerate(_deliveries(spark, sf)):
        stream = spark.readStream.schema(ENVELOPE).parquet(source)
        apply = lambda log, batch_id, n=n: warehouse.apply(log, 1000 * n + batch_id)
        _finish(maintain_stream(stream, apply, f"{path}/checkpoint-{n}", ONCE))
    return warehouse.tables()["agg_daily_sales"]


# flagship ---------------------------------------------------------------------


@query("purchases_by_last_state", "D6 J2 A1 P2", f"""WITH {o.USER_DIM}, {o.PURCHASES}, f AS ({o.PIT}),
g AS (SELECT last_seen, count(*) AS purchases, count(DISTINCT user_id) AS users, CAST(sum({o.cents('value')}) AS BIGINT) AS cents,
      count(user_key) AS keyed FROM f GROUP BY last_seen)
SELECT last_seen, purchases, users, {o.money('cents')} AS revenue, {o.money(o.half_up('cents', 'purchases'))} AS mean_value, keyed FROM g""")
def purchases_by_last_state(spark, sf):
    """Event log to versioned users, purchases to the state of the user at that moment."""
    found = _pit("auto")(spark, sf)
    return found.groupBy("last_seen").agg(
        F.count(F.lit(1)).alias("purchases"), F.count_distinct("user_id").alias("users"),
        sum_money(F.col("value")).alias("revenue"), mean_money(F.col("value")).alias("mean_value"),
        F.count("user_key").alias("keyed"),
    )
