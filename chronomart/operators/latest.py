"""Latest state per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronomart.functions.payload import normalize_op


def latest_state(df: DataFrame, keys: list[str], order: list[str], ascending: bool = False) -> DataFrame:
    """The newest row per key (the oldest with ``ascending``).

    Catalyst limits the rank before the exchange, so a hot key sends at most one
    row per map task. Nulls in ``order`` lose. End ``order`` with a unique column.
    """
    by = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in order]
    newest = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def deletes_kept(df: DataFrame, deletes: str) -> DataFrame:
    """``keep`` shows a deleted row with its last image, ``drop`` hides it."""
    if deletes == "keep":
        return df
    if deletes == "drop":
        return df.filter(F.coalesce(normalize_op(F.col("operation")) != "delete", F.lit(True)))
    raise ValueError(f"deletes must be keep or drop, not {deletes!r}")
