"""Declared schemas: nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_IMAGE = T.MapType(T.StringType(), T.StringType())

ENVELOPE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("before", ROW_IMAGE),
        T.StructField("after", ROW_IMAGE),
        T.StructField("captured_at", T.StringType()),
        T.StructField("change_id", T.LongType()),
    ]
)

CORRUPT = "_corrupt_record"

# Rows of a relational change-log table: row images are JSON text.
CHANGE_TABLE = T.StructType(
    [
        T.StructField("change_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("before_state", T.StringType()),
        T.StructField("after_state", T.StringType()),
        T.StructField("captured_at", T.StringType()),
        T.StructField("processed", T.BooleanType()),
    ]
)

# Native connector message, with or without the {"schema", "payload"} wrapper.
_CONNECTOR_BODY = [
    T.StructField("before", ROW_IMAGE),
    T.StructField("after", ROW_IMAGE),
    T.StructField(
        "source",
        T.StructType([T.StructField("table", T.StringType()), T.StructField("lsn", T.LongType())]),
    ),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
]
CONNECTOR = T.StructType(_CONNECTOR_BODY + [T.StructField("payload", T.StructType(_CONNECTOR_BODY))])

def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def extend(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    """A new schema; ``StructType.add`` would change the given one."""
    return T.StructType(schema.fields + struct(**columns).fields)


_ID, _INT, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()

SOURCE_TABLES = {
    "customers": struct(
        customer_id=_ID, name=_TEXT, email=_TEXT, address=_TEXT, created_at=_TIME, updated_at=_TIME
    ),
    "products": struct(
        product_id=_ID, name=_TEXT, category=_TEXT, price=T.DecimalType(10, 2), updated_at=_TIME
    ),
    "orders": struct(
        order_id=_ID, customer_id=_ID, order_date=_TIME, status=_TEXT, total_amount=T.DecimalType(12, 2)
    ),
    "order_items": struct(
        order_item_id=_ID, order_id=_ID, product_id=_ID, quantity=_INT, unit_price=T.DecimalType(10, 2)
    ),
    "inventory": struct(product_id=_ID, warehouse_id=_TEXT, stock_level=_INT, updated_at=_TIME),
}

TABLE_KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "inventory": ["product_id"],
}

# The accepted operation names and their long forms.
OPERATIONS = {
    "insert": "insert",
    "update": "update",
    "delete": "delete",
    "c": "insert",
    "u": "update",
    "d": "delete",
}

# The accepted order states.
ORDER_STATUSES = ["pending", "shipped", "delivered", "cancelled"]
