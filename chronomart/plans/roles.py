"""The shared test tables in the roles of a change-data warehouse.

Every role covers whole tables. The SQL of the same roles is in ``oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.operators.scd2 import Scd2

START = "1995-06-01 08:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ts: str, offset_hours: int = 0) -> str:
    """SQL for the ISO-8601 text of a UTC timestamp in a fixed offset."""
    pattern = "yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS"
    return f"concat(date_format({ts} + INTERVAL '{offset_hours}' HOUR, '{pattern}'), '+{offset_hours:02d}:00')"


# events as a change log and as facts ----------------------------------------

USERS = Scd2(
    keys=["user_id"], tracked=["event_type"], valid_from="ts", tiebreak=["event_id"], key_name="user_key"
)

_EVENT_ROW = "map('user_id', string(user_id), 'type', event_type, 'value', string(value))"


def events_envelope(events: DataFrame) -> DataFrame:
    """Events as change events: purchases of orders, the rest of customers; errors are deletes."""
    rows = events.selectExpr("event_id", "event_type", f"{_EVENT_ROW} AS row", f"{iso('ts')} AS captured_at")
    return rows.selectExpr(
        "if(event_type = 'purchase', 'orders', 'customers') AS `table`",
        "CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'insert' WHEN 'error' THEN 'delete' "
        "WHEN 'view' THEN 'u' ELSE 'update' END AS operation",
        "if(event_type IN ('error', 'view', 'click'), row, NULL) AS before",
        "if(event_type <> 'error', row, NULL) AS after",
        "captured_at",
        "event_id AS change_id",
    )


def events_json(events: DataFrame) -> DataFrame:
    """The same as JSON text, one event per row."""
    return events_envelope(events).select(F.to_json(F.struct("*")).alias("value"))


def user_events(events: DataFrame) -> DataFrame:
    return events.filter("event_type <> 'purchase'")


def purchases(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


# lineitem as price history ---------------------------------------------------

PRICES = Scd2(
    keys=["l_partkey"],
    tracked=["l_discount"],
    carried=["l_returnflag"],
    valid_from="l_shipdate",
    tiebreak=["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"],
    key_name="price_key",
)


# the retail tables as one change log -----------------------------------------


def _event(df: DataFrame, name: str, operation: str, image: dict[str, str], captured: str, change_id: str,
           absent: tuple[str, str] | None = None) -> DataFrame:
    """Rows of ``df`` as change events of one table; all arguments are SQL.

    ``absent`` = (key, condition) leaves a key out of the image.
    """
    def row_image(left_out: str | None = None) -> str:
        return "map(" + ", ".join(f"'{k}', string({v})" for k, v in image.items() if k != left_out) + ")"

    row = f"if({absent[1]}, {row_image(absent[0])}, {row_image()})" if absent else row_image()
    rows = df.selectExpr(
        f"{operation} AS operation", f"{row} AS row", f"{captured} AS captured_at", f"bigint({change_id}) AS change_id"
    )
    return rows.selectExpr(
        f"'{name}' AS `table`",
        "operation",
        "if(operation IN ('delete', 'd'), row, NULL) AS before",
        "if(operation IN ('delete', 'd'), NULL, row) AS after",
        "captured_at",
        "change_id",
    )


_START = iso(f"TIMESTAMP_NTZ '{START}'")


def customers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers exist from ``START``; 30 days after an order its priority is their address."""
    new = _event(
        table(spark, sf_dir, "customer"), "customers", "'c'",
        {
            "customer_id": "c_custkey", "name": "concat('  ', c_name, ' ')",
            "email": "concat(' ', upper(c_name), '@Example.COM')", "address": "concat(c_mktsegment, ' ')",
            "created_at": _START, "updated_at": _START,
        },
        _START, "c_custkey",
    )
    moved_at = "o_orderdate + INTERVAL '30' DAY"
    name = "concat('Customer#', lpad(string(o_custkey), 9, '0'))"
    moved = _event(
        table(spark, sf_dir, "orders"), "customers", "'update'",
        {
            "customer_id": "o_custkey", "name": name, "email": f"concat({name}, '@example.com')",
            "address": "concat(' ', o_orderpriority)", "created_at": _START,
            "updated_at": f"if(o_orderstatus = 'P', '', {iso(moved_at, 2)})",
        },
        iso(moved_at), "10000000000 + o_orderkey",
    )
    return new.unionByName(moved)


def products_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products exist from ``START``; a shipment sets their price and category."""
    new = _event(
        table(spark, sf_dir, "part"), "products", "'insert'",
        {
            "product_id": "p_partkey", "name": "p_name", "category": "p_brand", "price": "p_retailprice",
            "updated_at": _START,
        },
        _START, "p_partkey",
    )
    shipped = _event(
        table(spark, sf_dir, "lineitem"), "products", "'u'",
        {
            "product_id": "l_partkey", "name": "concat('Part ', l_partkey)",
            "category": "concat(' ', l_returnflag, ' ')", "price": "l_discount", "updated_at": iso("l_shipdate"),
        },
        iso("l_shipdate"), "10000000000 + l_orderkey * 8 + l_linenumber", absent=("price", "l_tax = 0"),
    )
    return new.unionByName(shipped)


_STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN ' shipped' "
    "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'cancelled' ELSE 'PENDING ' END"
)


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order arrives as pending and has its final state three days later."""
    orders = table(spark, sf_dir, "orders")

    def image(status: str) -> dict[str, str]:
        return {
            "order_id": "o_orderkey", "customer_id": "o_custkey", "order_date": iso("o_orderdate", 3),
            "status": status, "total_amount": "o_totalprice",
        }

    placed = _event(orders, "orders", "'insert'", image("'pending'"), iso("o_orderdate"), "o_orderkey * 2")
    settled = _event(
        orders, "orders", "'u'", image(_STATUS), iso("o_orderdate + INTERVAL '3' DAY"), "o_orderkey * 2 + 1"
    )
    return placed.unionByName(settled)


def order_items_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; a line number used twice is an update, a returned line a delete."""
    return _event(
        table(spark, sf_dir, "lineitem"), "order_items", "if(l_returnflag = 'R', 'delete', 'insert')",
        {
            "order_item_id": "l_orderkey * 8 + l_linenumber", "order_id": "l_orderkey", "product_id": "l_partkey",
            "quantity": "l_quantity", "unit_price": "l_extendedprice",
        },
        iso("l_shipdate"), "l_partkey", absent=("quantity", "l_tax = 0"),
    )


def inventory_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event(
        table(spark, sf_dir, "lineitem"), "inventory", "'update'",
        {
            "product_id": "l_partkey", "warehouse_id": "concat('W', l_suppkey)", "stock_level": "l_quantity",
            "updated_at": iso("l_shipdate"),
        },
        iso("l_shipdate"), "l_orderkey * 8 + l_linenumber", absent=("stock_level", "l_tax = 0"),
    )


LOGS = {
    "customers": customers_log,
    "products": products_log,
    "orders": orders_log,
    "order_items": order_items_log,
    "inventory": inventory_log,
}


def retail_log(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The change log of the named retail tables, of all five by default."""
    parts = [LOGS[name](spark, sf_dir) for name in names or LOGS]
    log = parts[0]
    for more in parts[1:]:
        log = log.unionByName(more)
    return log
