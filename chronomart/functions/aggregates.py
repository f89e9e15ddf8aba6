"""Conditional aggregates; each one is a map-side combined hash aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronomart.functions.money import mean_money, sum_money


def sum_if(condition: Column, value: Column, zero=0) -> Column:
    """SUM over all rows where rows that do not match count as zero."""
    return F.sum(F.when(condition, value).otherwise(F.lit(zero)))


def sum_money_if(condition: Column, amount: Column) -> Column:
    return sum_money(F.when(condition, amount).otherwise(F.lit(0.0)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def avg_if(condition: Column, amount: Column) -> Column:
    """Money average over the matching rows; NULL when there are none."""
    return mean_money(F.when(condition, amount))
