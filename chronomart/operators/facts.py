"""Order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.functions.money import from_cents, to_cents
from chronomart.operators.joins import point_in_time


def order_summary(items: DataFrame) -> DataFrame:
    """Per order: number of items, units and the item total."""
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
        from_cents(F.sum(to_cents(F.col("item_subtotal")))).alias("calculated_item_total"),
    )


def orders_base(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with item totals; orders without items show 0."""
    summary = order_summary(items).select(
        F.col("order_id").alias("_order"), "total_items", "total_quantity"
    )
    return orders.join(summary, orders["order_id"] == summary["_order"], "left").select(
        "order_id", "customer_id", "order_date", "status", "total_amount",
        F.coalesce("total_items", F.lit(0)).alias("total_items"),
        F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"),
    )


def fct_orders(orders: DataFrame, items: DataFrame, dim_customers: DataFrame, method: str = "auto", **limits) -> DataFrame:
    """One row per order with the customer version valid at order time."""
    limits.setdefault("sizes", orders.select("customer_id").union(dim_customers.select("customer_id")))
    keyed = point_in_time(
        orders_base(orders, items), dim_customers, "customer_id", "order_date", "customer_id",
        ["customer_key"], ["order_id"], method, **limits,
    )
    return keyed.select(
        "order_id", "customer_key", "customer_id", "order_date", "status", "total_amount",
        "total_items", "total_quantity",
    )


def dated_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order items with what their order says; items without an order keep NULLs."""
    return items.join(orders.select("order_id", "customer_id", "order_date", "status"), "order_id", "left")


def fct_order_items(items: DataFrame, orders: DataFrame, dim_products: DataFrame, method: str = "auto", **limits) -> DataFrame:
    """One row per order item with the product version valid at order time."""
    limits.setdefault("sizes", items.select("product_id").union(dim_products.select("product_id")))
    return keyed_items(dated_items(items, orders), dim_products, method, **limits)


def keyed_items(dated: DataFrame, dim_products: DataFrame, method: str = "auto", **limits) -> DataFrame:
    """The same for items that have the columns of their order already."""
    keyed = point_in_time(
        dated, dim_products, "product_id", "order_date", "product_id",
        ["product_key"], ["order_item_id"], method, key_attribute="product_key", **limits,
    )
    return keyed.select(
        "order_item_id", "order_id", "product_key", "product_id", "customer_id", "order_date",
        "status", "quantity", "unit_price", "item_subtotal",
    )


def reconcile(orders: DataFrame, items: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Orders whose amount differs from the sum of their items by more than ``tolerance``."""
    summary = order_summary(items).select(F.col("order_id").alias("_order"), "calculated_item_total")
    paired = orders.join(summary, orders["order_id"] == summary["_order"], "left")
    total = F.coalesce("calculated_item_total", F.lit(0.0))
    gap = from_cents(to_cents(F.col("total_amount")) - to_cents(total))
    return paired.select(
        "order_id", "total_amount", total.alias("calculated_item_total"), gap.alias("difference")
    ).filter(F.abs("difference") > tolerance)
