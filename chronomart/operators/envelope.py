"""Change events: parse, validate, normalise, route, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.payload import field, normalize_op
from chronomart.functions.times import capture_date
from chronomart.schemas import CONNECTOR, CORRUPT, ENVELOPE, OPERATIONS, ROW_IMAGE, extend

FIELDS = ENVELOPE.fieldNames()


def image(text: Column) -> Column:
    """Row image from JSON text; empty text counts as no image."""
    return F.from_json(F.nullif(F.trim(text), F.lit("")), ROW_IMAGE)


def parse_envelope(df: DataFrame, col: str = "value") -> DataFrame:
    """JSON text to envelope columns; text that is no JSON object is kept in ``_corrupt_record``.

    ``inline`` keeps later filters above the parser, so each text is parsed once.
    """
    schema = extend(ENVELOPE, **{CORRUPT: T.StringType()})
    parsed = F.from_json(
        F.col(col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return df.filter(F.trim(col) != "").select(F.inline(F.array(parsed)))


def from_change_table(df: DataFrame) -> DataFrame:
    """Rows of a relational change-log table, with row images as JSON text."""
    return df.select(
        F.col("table_name").alias("table"),
        "operation",
        image(F.col("before_state")).alias("before"),
        image(F.col("after_state")).alias("after"),
        F.col("captured_at").cast("string").alias("captured_at"),
        "change_id",
    )


def from_connector(
    df: DataFrame, col: str = "value", snapshot_op: str | None = "insert", keep_malformed: bool = False
) -> DataFrame:
    """Native connector message to the canonical envelope.

    Messages may carry the ``{"schema", "payload"}`` wrapper. Reads of an initial
    snapshot (``op = r``) become ``snapshot_op``; NULL text (a tombstone) is no event.
    ``keep_malformed`` adds text that is no JSON object as ``_corrupt_record``.
    """
    schema = extend(CONNECTOR, **{CORRUPT: T.StringType()}) if keep_malformed else CONNECTOR
    message = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = df.filter(F.col(col).isNotNull()).select(F.explode(F.array(message)).alias("_m"))
    body = {
        name: F.coalesce(F.col(f"_m.{name}"), F.col(f"_m.payload.{name}"))
        for name in ("before", "after", "source", "op", "ts_ms")
    }
    operation = body["op"]
    if snapshot_op is not None:
        operation = F.when(operation == "r", F.lit(snapshot_op)).otherwise(operation)
    moment = F.timestamp_add("MILLISECOND", body["ts_ms"], F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return df.select(
        body["source"]["table"].alias("table"),
        normalize_op(operation).alias("operation"),
        body["before"].alias("before"),
        body["after"].alias("after"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'").alias("captured_at"),
        body["source"]["lsn"].alias("change_id"),
        *([F.col(f"_m.{CORRUPT}").alias(CORRUPT)] if keep_malformed else []),
    )


def is_valid_envelope(df: DataFrame) -> Column:
    known = F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False))
    valid = F.col("table").isNotNull() & F.col("captured_at").isNotNull() & known
    if CORRUPT in df.columns:
        valid = valid & F.col(CORRUPT).isNull()
    return valid


def validate_envelope(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): table, operation and captured_at present, operation known as written."""
    valid = is_valid_envelope(df)
    good = df.filter(valid).select(
        *[normalize_op(F.col(c)).alias(c) if c == "operation" else F.col(c) for c in FIELDS]
    )
    return good, df.filter(~valid)


def payload_column() -> Column:
    """After image, else before image; an empty image counts as absent."""
    return F.when(F.size("after") > 0, F.col("after")).when(F.size("before") > 0, F.col("before"))


def payload(df: DataFrame) -> DataFrame:
    """Adds ``payload``; events without any image are no rows.

    Exploding the one image, rather than filtering on it, keeps Catalyst from
    computing it again in a pushed-down filter. NULL explodes to no row.
    """
    one = F.when(F.size("after") > 0, F.array("after")).when(F.size("before") > 0, F.array("before"))
    return df.select("*", F.explode(one).alias("payload"))


def check_invariants(df: DataFrame) -> DataFrame:
    """Count per table and operation of images that the operation should not, or should, have."""
    op = normalize_op(F.col("operation"))
    before, after = (F.coalesce(F.size(c) > 0, F.lit(False)) for c in ("before", "after"))
    rules = {
        "insert_with_before": (op == "insert") & before,
        "insert_without_after": (op == "insert") & ~after,
        "update_without_before": (op == "update") & ~before,
        "update_without_after": (op == "update") & ~after,
        "delete_with_after": (op == "delete") & after,
        "delete_without_before": (op == "delete") & ~before,
    }
    return df.groupBy("table", op.alias("operation")).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )


def route(df: DataFrame, table: str) -> DataFrame:
    return df.filter(F.col("table") == table)


def change_stats(df: DataFrame) -> DataFrame:
    """Event counts by table, by operation and in total, in one pass over the log."""
    return df.groupingSets([["table"], ["operation"], []], "table", "operation").agg(
        F.when(F.grouping("table") == 0, F.lit("table"))
        .when(F.grouping("operation") == 0, F.lit("operation"))
        .otherwise(F.lit("total"))
        .alias("breakdown"),
        F.count(F.lit(1)).alias("events"),
    )


def sample_events(df: DataFrame, order: tuple[str, ...] = ("change_id",)) -> DataFrame:
    """First event per table and operation. A rank limit runs before the shuffle."""
    first = Window.partitionBy("table", "operation").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def with_capture_date(df: DataFrame, unreadable: Column | None = None) -> DataFrame:
    return df.withColumn("event_date", capture_date(F.col("captured_at"), unreadable))


def validation_view(log: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Every event of a table as text columns plus ``_operation`` and ``_captured_at``."""
    return payload(route(log, table)).select(
        *[field(F.col("payload"), c).alias(c) for c in columns],
        F.col("operation").alias("_operation"),
        F.col("captured_at").alias("_captured_at"),
        F.col("change_id").alias("_change_id"),
    )


def dedupe(df: DataFrame) -> DataFrame:
    """One row per (table, change_id). Events without an id cannot be told apart and stay."""
    keyed = df.filter(F.col("change_id").isNotNull()).dropDuplicates(["table", "change_id"])
    return keyed.unionByName(df.filter(F.col("change_id").isNull()))
