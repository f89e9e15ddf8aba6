"""Lookups in a row image (``map<string,string>``) and coercing casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronomart.schemas import OPERATIONS


def normalize_op(operation: Column) -> Column:
    """Short operation codes to long names; other text passes through in lower case."""
    names = F.create_map(*[F.lit(v) for pair in OPERATIONS.items() for v in pair])
    low = F.lower(operation)
    return F.coalesce(F.try_element_at(names, low), low)


def field(image: Column, key: str) -> Column:
    return F.try_element_at(image, F.lit(key))


def get_or(image: Column, key: str, cast, default) -> Column:
    """``cast(image[key])``; ``default`` only where the key is absent.

    A key that is present but NULL or not castable gives NULL, for quarantine.
    """
    value = field(image, key)
    return F.when(value.isNotNull(), cast(value)).when(~F.map_contains_key(image, key), F.lit(default))


def first_truthy(*texts: Column) -> Column:
    """First text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def to_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def _whole(text: Column, fit, kind: str) -> Column:
    # Decimal text is told apart first: a failing integer cast costs an exception per row.
    text = F.trim(text)
    decimal = text.contains(".") | F.lower(text).contains("e")
    return F.when(decimal, fit(text.try_cast("double")).try_cast(kind)).otherwise(text.try_cast(kind))


def to_id(text: Column) -> Column:
    """Integer text as a 64-bit id; a decimal id is rounded, as a database cast does."""
    return _whole(text, F.round, "bigint")


def to_whole(text: Column) -> Column:
    """Integer text as a 32-bit count; a decimal count is cut towards zero."""
    return _whole(text, lambda c: F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)), "int")


def surrogate_key(keys: list[Column], valid_from: Column) -> Column:
    """md5 over ``id-valid_from``; NULL when a part is NULL."""
    parts: list[Column] = []
    for key in keys:
        parts += [key.cast("string"), F.lit("-")]
    return F.md5(F.concat(*parts, valid_from.cast("string")))


def contains(text: Column, pattern: str) -> Column:
    """Regex test that is false, not NULL, for NULL text."""
    return F.coalesce(text.cast("string").rlike(pattern), F.lit(False))
