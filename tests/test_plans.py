"""The physical plans we rely on at scale."""

from pyspark.sql import functions as F

from chronomart.operators import facts, joins, latest, marts, scd2
from chronomart.operators.diff import diff_runs
from chronomart.plans import catalog, roles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, sf, name):
    return roles.table(spark, sf, name)


def test_scd2_has_one_exchange_and_one_sort(spark, sf):
    text = plan(scd2.scd2(table(spark, sf, "lineitem"), roles.PRICES))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    assert "l_tax" not in text


def test_latest_state_limits_before_the_exchange(spark, sf):
    text = plan(latest.latest_state(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]))
    above, below = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_interval_join_is_an_equi_join(spark, sf):
    events = table(spark, sf, "events")
    dim = scd2.scd2(events, roles.USERS)
    args = (roles.purchases(events), dim, "user_id", "ts", "user_id", ["user_key"])
    small = plan(joins.pit_join(*args))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(joins.pit_join(*args))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in small + large
    assert "SortMergeJoin" in large
    assert "Cartesian" not in small + large


def test_semi_and_anti_joins(spark, sf):
    dim = scd2.scd2(table(spark, sf, "lineitem"), roles.PRICES)
    assert "LeftSemi" in plan(scd2.multi_version(dim, ["l_partkey"]))
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    assert "LeftAnti" in plan(joins.fk_violations(orders, customer, "o_custkey", "c_custkey"))
    counted = plan(joins.fk_violation_count(orders, customer, "o_custkey", "c_custkey"))
    assert "Join" not in counted and counted.count("hashpartitioning") == 1


def test_aggregates_combine_before_the_exchange(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.lit(1).alias("quantity"), F.col("l_extendedprice").alias("item_subtotal"),
    )
    text = plan(facts.order_summary(items))
    assert "partial_sum" in text and text.count("Exchange") == 1
    assert "partial_sum" in plan(diff_runs(items, items))


def test_filters_and_columns_reach_the_scan(spark, sf):
    dim = scd2.scd2(table(spark, sf, "events"), roles.USERS)
    text = plan(scd2.history(dim, "user_id", 8))
    assert "EqualTo(user_id,8)" in text
    assert "props" not in text


def test_top_k_is_not_a_global_sort(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").alias("order_date"), F.col("o_orderkey").alias("order_id"))
    assert "TakeOrderedAndProject" in plan(marts.latest_orders(orders, 5))


def test_aqe_splits_a_hot_fact_key(spark):
    """Two thirds of the facts on one key: the interval join reads that partition in parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fact = spark.range(0, 300000, 1, 8).select(
            "id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 1000).alias("k"),
            F.expr("timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, id % 86400)").alias("at"),
        )
        dim = spark.range(1000).select(
            F.col("id").alias("k"), F.col("id").alias("version"), F.expr("timestamp_ntz'2025-01-01'").alias("valid_from"),
            F.expr("CAST(NULL AS timestamp_ntz)").alias("valid_to"),
        )
        joined = joins.pit_join(fact, dim, "k", "at", "k", ["version"])
        joined.collect()
        assert "skew=true" in plan(joined)
        assert tuple(joined.agg(F.count(F.lit(1)), F.count("version")).first()) == (300000, 300000)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_bucketed_tables_join_without_an_exchange(spark, sf):
    orders, items = catalog.bucketed_orders(spark, sf, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.orders_base(orders, items)
        assert joined.count() == orders.count()
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text and "SortMergeJoin" in text
