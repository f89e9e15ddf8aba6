"""What is wrong with a change event, told beside the event itself.

``with_errors`` keeps good and bad rows in one pass and adds the reasons, each with the
column and the text that caused it. Nothing turns into NULL unnoticed: a value that is
present and can't be read is an error, an absent one is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.payload import field, normalize_op, to_double, to_id, to_whole
from chronomart.functions.times import parse_ts
from chronomart.operators.envelope import payload_column
from chronomart.operators.staging import REQUIRED_NUMBERS
from chronomart.schemas import CORRUPT, OPERATIONS, SOURCE_TABLES

ERRORS = "_errors"
_ERROR = "struct<cause:string,column:string,value:string>"


def _error(condition: Column, cause: str, column: str | None, value: Column | None = None) -> Column:
    told = F.struct(F.lit(cause).alias("cause"), F.lit(column).alias("column"), (F.lit(None) if value is None else value).alias("value"))
    return F.when(condition, told.cast(_ERROR))


def _value_errors(table: str) -> list[Column]:
    """Values of a table's row image that its schema can't take."""
    image, out = payload_column(), []
    for column in SOURCE_TABLES[table]:
        text = field(image, column.name)
        if column.name in REQUIRED_NUMBERS[table]:
            # A number that is present has to be one; absent, it has a default.
            read = to_whole if isinstance(column.dataType, T.IntegerType) else to_double
            bad = F.map_contains_key(image, F.lit(column.name)) & read(text).isNull()
        elif isinstance(column.dataType, T.LongType):
            bad = text.isNotNull() & to_id(text).isNull()
        elif isinstance(column.dataType, T.TimestampType):
            bad = (F.trim(text) != "") & parse_ts(text).isNull()
        else:
            continue
        out.append(_error(bad, "unreadable", column.name, text))
    return out


def errors(df: DataFrame) -> Column:
    """All reasons why an event can't be loaded; an empty array for a good one."""
    known = F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False))
    found = [
        _error(F.col("table").isNull(), "missing", "table"),
        _error(F.col("captured_at").isNull(), "missing", "captured_at"),
        _error(parse_ts(F.col("captured_at")).isNull() & F.col("captured_at").isNotNull(), "unreadable", "captured_at", F.col("captured_at")),
        _error(~known, "unknown", "operation", F.col("operation")),
    ]
    if CORRUPT in df.columns:
        whole = _error(F.col(CORRUPT).isNotNull(), "malformed", None, F.col(CORRUPT))
        found = [whole, *[F.when(F.col(CORRUPT).isNull(), e) for e in found]]
    lists = [F.array(*found)]
    lists += [F.when(F.col("table") == t, F.array(*_value_errors(t))).otherwise(F.array().cast(f"array<{_ERROR}>")) for t in SOURCE_TABLES]
    return F.array_compact(F.concat(*lists))


def with_errors(log: DataFrame) -> DataFrame:
    """The log with ``_errors`` and operations in their long form."""
    marked = log.withColumn(ERRORS, errors(log))
    return marked.withColumn("operation", F.when(F.size(ERRORS) == 0, normalize_op(F.col("operation"))).otherwise(F.col("operation")))


def error_counts(bad: DataFrame) -> DataFrame:
    """Bad events per table, cause and column; an event with two reasons counts under both."""
    told = bad.select("table", F.inline(ERRORS))
    return told.groupBy("table", "cause", "column").agg(F.count(F.lit(1)).alias("events"))
