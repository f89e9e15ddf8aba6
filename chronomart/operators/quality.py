"""Expectations on tables: counts in one pass, violating rows, quarantine, gate."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.payload import contains
from chronomart.operators.joins import fk_violations
from chronomart.operators.ordered import HOT_ROWS, Groups, per_group
from chronomart.schemas import ORDER_STATUSES


class RowExpectation:
    """An expectation that one row alone can break."""

    column: str
    kind: str

    def broken(self, df: DataFrame) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowExpectation):
    column: str
    reject_zero: bool = False
    kind = "not_null"

    def broken(self, df):
        missing = F.col(self.column).isNull()
        if self.reject_zero:
            number = F.col(self.column).try_cast("double")
            missing = missing | F.coalesce(number == 0, F.lit(False))
        return missing


@dataclass(frozen=True)
class Between(RowExpectation):
    """Numeric range. ``null_ok`` decides on NULL and on text that is no number."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    null_ok: bool = True
    kind = "between"

    def broken(self, df):
        number = F.col(self.column).try_cast("double")
        number = F.when(~F.isnan(number), number)
        outside = F.lit(False)
        if self.min_value is not None:
            low = F.lit(float(self.min_value))
            outside = outside | ((number <= low) if self.strict_min else (number < low))
        if self.max_value is not None:
            outside = outside | (number > F.lit(float(self.max_value)))
        return F.coalesce(outside, F.lit(False)) | (F.lit(not self.null_ok) & number.isNull())


@dataclass(frozen=True)
class InSet(RowExpectation):
    column: str
    values: tuple
    kind = "in_set"

    def broken(self, df):
        return ~F.coalesce(F.col(self.column).isin(*self.values), F.lit(False))


@dataclass(frozen=True)
class Matches(RowExpectation):
    column: str
    pattern: str
    kind = "matches"

    def broken(self, df):
        return ~contains(F.col(self.column), self.pattern)


@dataclass(frozen=True)
class References:
    """Every value occurs in ``parent.parent_column``; an empty parent is not checked."""

    column: str
    parent: str
    parent_column: str
    kind = "references"


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; violations are the values that do. NULLs are not compared."""

    column: str
    kind = "unique"


Suites = Mapping[str, Sequence]

RESULT = "suite string, expectation string, column string, evaluated bigint, violations bigint, success boolean"

# What the source tables have to satisfy.
SOURCE_SUITES: dict[str, list] = {
    "products": [
        NotNull("product_id", reject_zero=True),
        Between("price", 0, strict_min=True, null_ok=False),
    ],
    "customers": [NotNull("customer_id", reject_zero=True), Matches("email", "@")],
    "orders": [
        NotNull("order_id"),
        NotNull("customer_id"),
        InSet("status", tuple(ORDER_STATUSES)),
        Between("total_amount", 0),
        References("customer_id", "customers", "customer_id"),
    ],
    "inventory": [Between("stock_level", 0)],
}

# Promised for the source, on top of the list above.
EXTRA_SUITES: dict[str, list] = {
    "products": [NotNull("name")],
    "order_items": [
        Between("quantity", 0, strict_min=True, null_ok=False),
        References("product_id", "products", "product_id"),
    ],
}

# What the finished models have to satisfy.
MODEL_SUITES: dict[str, list] = {
    "stg_customers": [NotNull("customer_id")],
    "stg_products": [NotNull("product_id"), NotNull("price")],
    "stg_orders": [
        Unique("order_id"),
        NotNull("order_id"),
        NotNull("customer_id"),
        InSet("status", tuple(ORDER_STATUSES)),
    ],
    "dim_customers_scd2": [
        Unique("customer_key"), NotNull("customer_key"), NotNull("customer_id"), NotNull("is_current"),
    ],
    "dim_products_scd2": [
        Unique("product_key"), NotNull("product_key"), NotNull("product_id"), NotNull("is_current"),
    ],
    "fct_orders": [Unique("order_id"), NotNull("order_id"), NotNull("customer_id"), NotNull("total_amount")],
    "agg_daily_sales": [Unique("sale_date"), NotNull("sale_date"), NotNull("total_orders")],
}


def merge_suites(*suites: Suites) -> dict[str, list]:
    names = list(dict.fromkeys(name for s in suites for name in s))
    return {name: [e for s in suites for e in s.get(name, [])] for name in names}


def load_suite(text: str) -> dict[str, list]:
    """Expectations declared as JSON: ``{"expectations": [{"expectation_type", "kwargs"}]}``."""
    out: dict[str, list] = {}
    for item in json.loads(text)["expectations"]:
        kind, args = item["expectation_type"], item["kwargs"]
        column = args["column"]
        if kind == "expect_column_values_to_not_be_null":
            made = NotNull(column)
        elif kind == "expect_column_values_to_be_between":
            made = Between(
                column, args.get("min_value"), args.get("max_value"), args.get("strict_min", False)
            )
        elif kind == "expect_column_values_to_be_in_set":
            made = InSet(column, tuple(args["value_set"]))
        elif kind == "expect_column_values_to_match_regex":
            made = Matches(column, args["regex"])
        elif kind == "expect_column_values_to_be_unique":
            made = Unique(column)
        else:
            raise ValueError(f"unknown expectation {kind!r}")
        out.setdefault(args["table"], []).append(made)
    return out


def load_model_tests(declared: Mapping) -> dict[str, list]:
    """Column tests declared per model: ``{"models": [{"name", "columns": [{"name", "tests"}]}]}``."""
    out: dict[str, list] = {}
    for model in declared["models"]:
        for column in model.get("columns", []):
            for test in column.get("tests", []):
                out.setdefault(model["name"], []).append(_model_test(column["name"], test))
    return out


def _model_test(column: str, test):
    if test == "not_null":
        return NotNull(column)
    if test == "unique":
        return Unique(column)
    if isinstance(test, Mapping) and "accepted_values" in test:
        return InSet(column, tuple(test["accepted_values"]["values"]))
    raise ValueError(f"unknown column test {test!r}")


def _key_text(value: Column, kind: T.DataType) -> Column:
    """Text that is equal exactly where the values are: zero has one sign, bytes are hex."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")


CHILD, PARENT = 0, 1
_VOTE = "struct<check:int,role:int,key:string>"


def _votes(df: DataFrame, votes: list[Column]) -> DataFrame:
    """One row per vote; a null vote (a rule that the row keeps) is none."""
    return df.select(F.inline(F.array_compact(F.array(*[v.cast(_VOTE) for v in votes]))))


def _vote(check: int, role: int = CHILD, key: Column | None = None) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(role).alias("role"), (F.lit(None) if key is None else key).alias("key"))


def run_suite(tables: Mapping[str, DataFrame], suites: Suites) -> DataFrame:
    """One result row per expectation. A table that is empty passes; one that a suite or a reference names and that is absent is an error.

    Each table is scanned once, whatever it is checked for: a row votes for itself, for
    the row rules that it breaks, and with its key for every uniqueness and for both sides
    of every reference. Votes are counted per check and key, combined before the one
    exchange, then per check.
    """
    rules = [(name, rule) for name, own in suites.items() for rule in own]
    named = set(suites) | {r.parent for _, r in rules if isinstance(r, References)}
    if absent := sorted(named - set(tables)):
        raise ValueError(f"the suites name tables that are absent: {', '.join(absent)}")
    if not rules:
        raise ValueError("no expectation applies to the given tables")
    # After the checks, one number per table for its rows.
    rows_of = {name: len(rules) + n for n, name in enumerate(sorted(named))}
    votes: dict[str, list[Column]] = {name: [_vote(n)] for name, n in rows_of.items() if name in suites}
    for n, (name, rule) in enumerate(rules):
        df = tables[name]
        if isinstance(rule, RowExpectation):
            votes[name].append(F.when(rule.broken(df), _vote(n)))
            continue
        kind = df.schema[rule.column].dataType
        votes[name].append(_vote(n, CHILD, _key_text(F.col(rule.column), kind)))
        if isinstance(rule, References):
            parent = F.col(rule.parent_column).cast(kind)
            votes.setdefault(rule.parent, []).append(_vote(n, PARENT, _key_text(parent, kind)))
    all_votes = reduce(DataFrame.unionAll, [_votes(tables[name], own) for name, own in votes.items()])
    per_key = all_votes.groupBy("check", "key").agg(F.count_if(F.col("role") == CHILD).alias("n"), F.max("role").alias("role"))
    per_check = per_key.groupBy("check").agg(
        F.sum("n").alias("n"),
        F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(F.col("role") == CHILD, F.col("n"))), F.lit(0)).alias("orphans"),
        F.max("role").alias("role"),
    )
    # One row with the counts of all checks: as many as there are expectations.
    counts = per_check.agg(F.map_from_entries(F.collect_list(F.struct("check", F.struct("n", "repeated", "orphans", "role")))).alias("counts"))
    return counts.select(F.inline(F.array(*[_line(n, name, rule, rows_of) for n, (name, rule) in enumerate(rules)]))).withColumn(
        "success", F.col("violations") == 0
    )


def _line(n: int, name: str, rule, rows_of: dict[str, int]) -> Column:
    def counted(check: int, what: str) -> Column:
        return F.coalesce(F.try_element_at("counts", F.lit(check))[what], F.lit(0))

    if isinstance(rule, RowExpectation):
        broken = counted(n, "n")
    elif isinstance(rule, Unique):
        broken = counted(n, "repeated")
    else:
        # Without any parent there is nothing to compare with.
        broken = F.when(counted(n, "role") == PARENT, counted(n, "orphans")).otherwise(0)
    return F.struct(
        F.lit(name).alias("suite"), F.lit(rule.kind).alias("expectation"), F.lit(rule.column).alias("column"),
        counted(rows_of[name], "n").cast("bigint").alias("evaluated"), broken.cast("bigint").alias("violations"),
    )


class Metrics:
    """Row expectations of several tables as metrics of a pass over their common log.

    ``watch`` adds the counts to a pass that is made anyway, ``results`` reads them when
    it has ended: the checks cost no scan of their own. A rule sees its column as
    text of the event's payload.
    """

    def __init__(self, suites: Suites) -> None:
        self.rules = [(name, r) for name, own in suites.items() for r in own if isinstance(r, RowExpectation)]
        self.tables = sorted({name for name, _ in self.rules})
        self.seen = Observation()

    def watch(self, log: DataFrame, table: Column, payload: Column) -> DataFrame:
        columns = sorted({r.column for _, r in self.rules})
        if clash := set(columns) & set(log.columns):
            raise ValueError(f"columns of the log stand in for columns of its tables: {', '.join(sorted(clash))}")
        wide = log.select("*", *[F.try_element_at(payload, F.lit(c)).alias(c) for c in columns])
        present = payload.isNotNull()
        counts = [F.count_if((table == t) & present).alias(f"rows_{t}") for t in self.tables]
        counts += [F.count_if((table == t) & present & r.broken(wide)).alias(f"v{n}") for n, (t, r) in enumerate(self.rules)]
        return wide.observe(self.seen, *counts).drop(*columns) if counts else log

    def results(self, spark: SparkSession) -> DataFrame:
        found = self.seen.get
        lines = [(t, r.kind, r.column, found[f"rows_{t}"], found[f"v{n}"], found[f"v{n}"] == 0) for n, (t, r) in enumerate(self.rules)]
        return spark.createDataFrame(lines, RESULT)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter("copies > 1")


class GateClosed(Exception):
    """The data broke an expectation; nothing after the gate ran."""


def gate(results: DataFrame) -> list:
    """Raises when an expectation failed. Collects one row per expectation, never data."""
    rows = results.collect()
    failed = [r for r in rows if not r["success"]]
    if failed:
        lines = ", ".join(
            f"{r['suite']}.{r['column']} {r['expectation']}: {r['violations']} of {r['evaluated']}" for r in failed
        )
        raise GateClosed(lines)
    return rows


def violations(df: DataFrame, rule, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows that break one expectation."""
    if isinstance(rule, RowExpectation):
        return df.filter(rule.broken(df))
    if isinstance(rule, References):
        return fk_violations(df, tables[rule.parent], rule.column, rule.parent_column)
    if isinstance(rule, Unique):
        return df.join(not_unique(df, rule.column).select(rule.column), rule.column, "left_semi")
    raise TypeError(rule)


FAILED = "_failed"


def quarantine(
    df: DataFrame, rules: Sequence, tables: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, bad): bad rows carry the names of what they break in ``_failed``.

    Every row goes to exactly one side. Uniqueness is a table property and is not
    judged per row.
    """
    columns = df.columns
    flags: list[Column] = []
    for rule in rules:
        name = F.lit(f"{rule.kind}({rule.column})")
        if isinstance(rule, RowExpectation):
            flags.append(F.when(rule.broken(df), name))
        elif isinstance(rule, References) and tables and not tables[rule.parent].isEmpty():
            mark = f"_p{len(flags)}"
            known = tables[rule.parent].select(F.col(rule.parent_column).alias(mark)).distinct()
            known = known.withColumn(f"{mark}_hit", F.lit(True))
            df = df.join(known, df[rule.column].eqNullSafe(known[mark]), "left").drop(mark)
            flags.append(F.when(F.col(f"{mark}_hit").isNull(), name))
    marked = df.withColumn(FAILED, F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>"))
    clean = marked.filter(F.size(FAILED) == 0).select(*columns)
    return clean, marked.filter(F.size(FAILED) > 0).select(*columns, FAILED)


# Checks on versioned dimensions ---------------------------------------------


def one_current(dim: DataFrame, key: str, entity_type: str) -> DataFrame:
    """Entities whose number of current versions is not exactly one, zero included."""
    current = F.sum(F.when(F.col("is_current"), 1).otherwise(0))
    counted = dim.groupBy(F.col(key).alias("entity_id")).agg(current.alias("current_rows"))
    return counted.filter("current_rows <> 1").select(F.lit(entity_type).alias("entity_type"), "entity_id", "current_rows")


def one_current_strict(dim: DataFrame, key: str, entity_type: str) -> DataFrame:
    """The same over current versions only: entities with none stay unseen."""
    counted = dim.filter("is_current").groupBy(F.col(key).alias("entity_id")).agg(F.count(F.lit(1)).alias("current_rows"))
    return counted.filter("current_rows <> 1").select(F.lit(entity_type).alias("entity_type"), "entity_id", "current_rows")


def valid_windows(dim: DataFrame, key: str, entity_type: str) -> DataFrame:
    """Versions that end before or when they start."""
    return dim.filter(F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))).select(
        F.lit(entity_type).alias("entity_type"), F.col(key).alias("entity_id"), "valid_from", "valid_to"
    )


def no_overlap(
    dim: DataFrame, key: str, entity_type: str, tiebreak: Sequence[str] = (), hot_rows: int | None = HOT_ROWS, **limits
) -> DataFrame:
    """Neighbouring versions that overlap, or leave a gap between them."""

    def work(groups: Groups) -> Groups:
        return groups.following(["valid_from"], "_next")

    end, start = F.col("valid_to"), F.col("_next_valid_from")
    finding = F.when(end.isNull() | (start < end), F.lit("overlap")).when(start > end, F.lit("gap"))
    rows = per_group(
        dim.select(key, "valid_from", "valid_to", *tiebreak), [key], ["valid_from", "valid_to", *tiebreak],
        work, hot_rows, **limits,
    )
    return (
        rows.filter(F.col("_next").isNotNull())
        .withColumn("finding", finding)
        .filter(F.col("finding").isNotNull())
        .select(
            F.lit(entity_type).alias("entity_type"), F.col(key).alias("entity_id"), "valid_from", "valid_to",
            start.alias("next_from"), "finding",
        )
    )

