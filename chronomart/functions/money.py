"""Exact money arithmetic.

Sums of doubles depend on the order in which partitions arrive, and engines
disagree on ``round`` at exact halves. Money is therefore counted in integer
cents, which add up the same under any partitioning, and halves round away from
zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    return F.round(amount * F.lit(100.0)).try_cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def round_money(amount: Column) -> Column:
    return from_cents(to_cents(amount))


def divide_half_up(num: Column, den: Column) -> Column:
    """``num / den`` rounded half away from zero, on integers; NULL when ``den`` is 0."""
    den = F.nullif(den, F.lit(0).cast("bigint"))
    magnitude = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -magnitude).otherwise(magnitude)


def sum_money(amount: Column) -> Column:
    return from_cents(F.sum(to_cents(amount)))


def mean_money(amount: Column) -> Column:
    cents = to_cents(amount)
    return from_cents(divide_half_up(F.sum(cents), F.count(cents)))


def percent(part: Column, total: Column, places: int = 2) -> Column:
    """``100 * part / total`` with a fixed number of decimals; NULL when ``total`` is 0."""
    scale = 10**places
    return divide_half_up(part * F.lit(100 * scale).cast("bigint"), total).cast("double") / F.lit(float(scale))
