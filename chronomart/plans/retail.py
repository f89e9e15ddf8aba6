"""The retail warehouse: change log in, dimensions, facts and daily mart out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.operators.diff import diff_counts
from chronomart.operators.envelope import FIELDS, payload_column, validation_view
from chronomart.operators.errors import ERRORS, with_errors
from chronomart.operators.facts import fct_order_items, fct_orders
from chronomart.operators.marts import daily_sales
from chronomart.operators.quality import (
    EXTRA_SUITES,
    MODEL_SUITES,
    SOURCE_SUITES,
    Metrics,
    RowExpectation,
    Suites,
    gate,
    merge_suites,
    run_suite,
)
from chronomart.operators.scd2 import dim_customers_scd2, dim_products_scd2
from chronomart.operators.staging import (
    stage_all,
    stg_customers,
    stg_inventory,
    stg_order_items,
    stg_orders,
    stg_products,
)
from chronomart.schemas import SOURCE_TABLES, extend
from chronomart.sources.changelog import drop_folder, refresh

ALL_SUITES = merge_suites(SOURCE_SUITES, EXTRA_SUITES)


def validation_views(log: DataFrame) -> dict[str, DataFrame]:
    return {t: validation_view(log, t, s.fieldNames()) for t, s in SOURCE_TABLES.items()}


def source_quality(log: DataFrame, suites: Suites = SOURCE_SUITES) -> DataFrame:
    """Expectation results over every event of the log."""
    return run_suite(validation_views(log), suites)


def staging_views(staged: dict[str, DataFrame], deletes: str = "keep") -> dict[str, DataFrame]:
    return {
        "stg_customers": stg_customers(staged["customers"]),
        "stg_products": stg_products(staged["products"]),
        "stg_orders": stg_orders(staged["orders"], deletes),
        "stg_order_items": stg_order_items(staged["order_items"], deletes),
        "stg_inventory": stg_inventory(staged["inventory"], deletes),
    }


def marts(views: dict[str, DataFrame], **limits) -> dict[str, DataFrame]:
    """The models over the staging views, in dependency order, all lazy."""
    out = dict(views)
    out["dim_customers_scd2"] = dim_customers_scd2(views["stg_customers"], **limits)
    out["dim_products_scd2"] = dim_products_scd2(views["stg_products"], **limits)
    out["fct_orders"] = fct_orders(views["stg_orders"], views["stg_order_items"], out["dim_customers_scd2"], **limits)
    out["fct_order_items"] = fct_order_items(
        views["stg_order_items"], views["stg_orders"], out["dim_products_scd2"], **limits
    )
    out["agg_daily_sales"] = daily_sales(out["fct_orders"])
    return out


def build(log: DataFrame, deletes: str = "keep", **limits) -> dict[str, DataFrame]:
    """Every model as a lazy DataFrame over the change log."""
    return marts(staging_views(stage_all(log), deletes), **limits)


@dataclass
class Loaded:
    """A log after its one pass: good events of the known tables, bad ones with their reasons, and the results of the row checks."""

    good: DataFrame
    bad: DataFrame
    results: DataFrame


def load_log(log: DataFrame, path: str, suites: Suites = SOURCE_SUITES) -> Loaded:
    """Writes ``log`` below ``path`` in one pass that parses it, splits it and counts the row checks."""
    metrics = Metrics(suites)
    watched = metrics.watch(with_errors(log), F.col("table"), payload_column())
    # Folders for the known tables only: names in bad events may be anything.
    known = F.when(F.col("table").isin(*SOURCE_TABLES), F.col("table"))
    watched.withColumns({"bad": F.size(ERRORS) > 0, "known": known}).write.partitionBy("bad", "known").parquet(path)
    schema = extend(watched.schema, bad=T.BooleanType(), known=T.StringType())
    stored = log.sparkSession.read.schema(schema).parquet(path)
    good = stored.filter(~F.col("bad") & F.col("known").isNotNull()).select(*[F.col("known").alias(c) if c == "table" else F.col(c) for c in FIELDS])
    return Loaded(good, stored.filter("bad").drop("bad", "known"), metrics.results(log.sparkSession))


def reference_results(good: DataFrame, suites: Suites) -> DataFrame | None:
    """The checks that compare tables, on the keys of the stored events; None where the suites have none."""
    between = {t: [r for r in own if not isinstance(r, RowExpectation)] for t, own in suites.items()}
    between = {t: own for t, own in between.items() if own}
    return run_suite(validation_views(good), between) if between else None


def run_warehouse(
    log: DataFrame, path: str, deletes: str = "keep", suites: Suites = SOURCE_SUITES, check: bool = True, **limits
) -> dict[str, DataFrame]:
    """Gate, load and transform, each stage stored as Parquet below ``path``.

    The log is parsed once, into a side folder: the same pass counts the row checks and
    tells good from bad events. ``path`` is written only when the gate is open; bad
    events go to ``quarantine`` there with their reasons. Staging and dimensions are
    written before their readers, so each is computed once. A rerun over the same log
    gives the same tables.
    """
    side = f"{path.rstrip('/')}-loading-{uuid.uuid4().hex}"
    try:
        loaded = load_log(log, side, suites)
        rows = loaded.results
        more = reference_results(loaded.good, suites)
        gate(rows if more is None else rows.unionByName(more))
        refresh(loaded.bad, f"{path}/quarantine")
        staged = {t: refresh(df, f"{path}/staging/{t}") for t, df in stage_all(loaded.good).items()}
    finally:
        drop_folder(log.sparkSession, side)
    views = staging_views(staged, deletes)
    out = dict(views)
    for name in ("stg_orders", "stg_order_items"):
        out[name] = refresh(views[name], f"{path}/{name}")
    out["dim_customers_scd2"] = refresh(
        dim_customers_scd2(views["stg_customers"], **limits), f"{path}/dim_customers_scd2"
    )
    out["dim_products_scd2"] = refresh(
        dim_products_scd2(views["stg_products"], **limits), f"{path}/dim_products_scd2"
    )
    out["fct_orders"] = refresh(
        fct_orders(out["stg_orders"], out["stg_order_items"], out["dim_customers_scd2"], **limits),
        f"{path}/fct_orders",
    )
    out["fct_order_items"] = refresh(
        fct_order_items(out["stg_order_items"], out["stg_orders"], out["dim_products_scd2"], **limits),
        f"{path}/fct_order_items",
    )
    out["agg_daily_sales"] = refresh(daily_sales(out["fct_orders"]), f"{path}/agg_daily_sales")
    if check:
        gate(run_suite(out, MODEL_SUITES))
    return out


def history_kept(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per entity: versions before and after, and versions lost on the way.

    A version is kept if the later dimension has it with the same start and
    attributes, and with the same end unless it was open.
    """
    names = [*keys, "valid_from", *columns]
    sides = before.select(*names, "valid_to", F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(*names, "valid_to", F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    end = lambda flag: F.max(F.when(F.col(flag) == 1, F.coalesce(F.col("valid_to").cast("string"), F.lit("open"))))
    one = sides.groupBy(*names).agg(F.sum("_b").alias("_b"), F.sum("_a").alias("_a"), end("_b").alias("_was"), end("_a").alias("_is"))
    lost = (F.col("_b") > F.col("_a")) | ((F.col("_b") > 0) & (F.col("_was") != "open") & (F.col("_was") != F.col("_is")))
    return one.groupBy(*keys).agg(
        F.sum("_b").alias("versions_before"), F.sum("_a").alias("versions_after"), F.count_if(F.coalesce(lost, F.lit(False))).alias("lost")
    )


def prove_idempotent(run, names: list[str]) -> dict[str, tuple[int, int]]:
    """Runs ``run() -> tables`` twice; per table the rows only in the first and only in the second."""
    first, second = run(), run()
    return {n: tuple(diff_counts(first[n], second[n]).first()) for n in names}
