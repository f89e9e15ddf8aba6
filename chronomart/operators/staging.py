"""Typed staging rows (one per event) and cleaned views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.money import round_money
from chronomart.functions.payload import field, first_truthy, get_or, to_double, to_id, to_whole
from chronomart.functions.times import parse_ts
from chronomart.operators.envelope import payload, payload_column, route
from chronomart.operators.latest import deletes_kept, latest_state

IMAGE = "payload"


def _text(key: str) -> Column:
    return field(F.col(IMAGE), key).alias(key)


def _id(key: str) -> Column:
    return to_id(field(F.col(IMAGE), key)).alias(key)


def _ts(key: str) -> Column:
    return parse_ts(first_truthy(field(F.col(IMAGE), key))).alias(key)


def _number(key: str) -> Column:
    return get_or(F.col(IMAGE), key, to_double, 0.0).alias(key)


def _count(key: str, default: int) -> Column:
    return get_or(F.col(IMAGE), key, to_whole, default).alias(key)


def _valid_from() -> Column:
    stamp = first_truthy(field(F.col(IMAGE), "updated_at"), F.col("captured_at"))
    return parse_ts(stamp).alias("valid_from")


def _captured() -> Column:
    return parse_ts(F.col("captured_at")).alias("captured_at")


def _stage(log: DataFrame, table: str, *columns: Column) -> DataFrame:
    return payload(route(log, table)).select(*columns, "change_id")


def stage_customers(log: DataFrame) -> DataFrame:
    return _stage(
        log, "customers", _id("customer_id"), _text("name"), _text("email"), _text("address"),
        F.col("operation"), _valid_from(), _captured(), _ts("created_at"), _ts("updated_at"),
    )


def stage_products(log: DataFrame) -> DataFrame:
    return _stage(
        log, "products", _id("product_id"), _text("name"), _text("category"), _number("price"),
        F.col("operation"), _valid_from(), _captured(), _ts("updated_at"),
    )


def stage_orders(log: DataFrame) -> DataFrame:
    return _stage(
        log, "orders", _id("order_id"), _id("customer_id"), _ts("order_date"), _text("status"),
        _number("total_amount"), F.col("operation"), _captured(),
    )


def stage_order_items(log: DataFrame) -> DataFrame:
    return _stage(
        log, "order_items", _id("order_item_id"), _id("order_id"), _id("product_id"),
        _count("quantity", 1), _number("unit_price"), F.col("operation"), _captured(),
    )


def stage_inventory(log: DataFrame) -> DataFrame:
    return _stage(
        log, "inventory", _id("product_id"), _text("warehouse_id"), _count("stock_level", 0),
        F.col("operation"), _captured(), _ts("updated_at"),
    )


STAGES = {
    "customers": stage_customers,
    "products": stage_products,
    "orders": stage_orders,
    "order_items": stage_order_items,
    "inventory": stage_inventory,
}

# Numbers that must be castable where their key is present.
REQUIRED_NUMBERS = {
    "customers": [],
    "products": ["price"],
    "orders": ["total_amount"],
    "order_items": ["quantity", "unit_price"],
    "inventory": ["stock_level"],
}


def is_unreadable(table: str) -> Column:
    """A number that is present but NULL or not a number: such events belong in quarantine."""
    image = payload_column()
    bad = F.lit(False)
    for key in REQUIRED_NUMBERS[table]:
        bad = bad | (F.map_contains_key(image, key) & to_double(field(image, key)).isNull())
    return F.coalesce(bad, F.lit(False))


def unreadable(log: DataFrame, table: str) -> DataFrame:
    return route(log, table).filter(is_unreadable(table))


def stage_all(log: DataFrame) -> dict[str, DataFrame]:
    return {table: stage(log) for table, stage in STAGES.items()}


# Cleaned views -------------------------------------------------------------


def stg_customers(staged: DataFrame) -> DataFrame:
    """Every event, text trimmed, e-mail in lower case."""
    return staged.select(
        "customer_id", F.trim("name").alias("name"), F.lower(F.trim("email")).alias("email"),
        F.trim("address").alias("address"), "operation", "valid_from", "captured_at",
        "created_at", "updated_at", "change_id",
    )


def stg_products(staged: DataFrame) -> DataFrame:
    return staged.select(
        "product_id", F.trim("name").alias("name"), F.trim("category").alias("category"),
        F.col("price").cast("double").alias("price"), "operation", "valid_from", "captured_at",
        "updated_at", "change_id",
    )


def _newest(staged: DataFrame, key: str, deletes: str) -> DataFrame:
    return deletes_kept(latest_state(staged, [key], ["captured_at", "change_id"]), deletes)


def stg_orders(staged: DataFrame, deletes: str = "keep") -> DataFrame:
    return _newest(staged, "order_id", deletes).select(
        "order_id", "customer_id", "order_date", F.lower(F.trim("status")).alias("status"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("captured_at").alias("last_updated_at"),
    )


def stg_order_items(staged: DataFrame, deletes: str = "keep") -> DataFrame:
    return _newest(staged, "order_item_id", deletes).select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        round_money(F.col("quantity") * F.col("unit_price")).alias("item_subtotal"), "captured_at",
    )


def stg_inventory(staged: DataFrame, deletes: str = "keep") -> DataFrame:
    """Newest stock per product; the warehouse is carried, not part of the key."""
    return _newest(staged, "product_id", deletes).select(
        "product_id", "warehouse_id", "stock_level", "captured_at", "updated_at",
    )
