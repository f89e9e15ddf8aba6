"""Hot groups in chunks give what the plain window gives."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronomart.operators import facts, joins, quality, scd2
from chronomart.operators.diff import diff_counts
from chronomart.operators.joins import asof_join, pit_join, point_in_time
from chronomart.operators.ordered import per_group
from chronomart.sources.scratch import shuffles_dropped

SMALL = {"hot_rows": 40, "chunk_rows": 25}


def log(spark, seed, rows=600):
    """Two thirds of all rows on one key, NULLs, ties in time."""
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        key = 1 if rnd.random() < 0.66 else rnd.choice([None, 2, 3, 4, 5])
        at = None if rnd.random() < 0.02 else f"2026-01-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:00:00"
        out.append((key, rnd.choice(["a", "b", None]), rnd.choice(["x", "y", None]), at, i, rnd.choice(["update", "delete"])))
    frame = spark.createDataFrame(out, "k int, p string, q string, at string, change_id long, operation string")
    return frame.withColumn("valid_from", F.col("at").cast("timestamp_ntz")).drop("at").repartition(5)


def same(left, right):
    return tuple(diff_counts(left, right).first()) == (0, 0)


@pytest.mark.parametrize("deletes", ["keep", "drop", "close"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_scd2(spark, deletes, null_safe):
    rows = log(spark, 1)
    spec = scd2.Scd2(["k"], ["p", "q"], tiebreak=["change_id"], deletes=deletes, null_safe=null_safe)
    plain = scd2.scd2(rows, spec, hot_rows=None)
    assert same(plain, scd2.scd2(rows, spec, **SMALL))
    assert plain.count() > 50


def test_whole_group_at_one_moment(spark):
    rows = log(spark, 2).withColumn("valid_from", F.lit("2026-01-01").cast("timestamp_ntz"))
    spec = scd2.Scd2(["k"], ["p"], tiebreak=["change_id"])
    assert same(scd2.scd2(rows, spec, hot_rows=None), scd2.scd2(rows, spec, **SMALL))


def test_number_and_latest_known(spark):
    rows = log(spark, 3)

    def work(groups):
        return groups.number("n").latest_known("p", "known").following(["q"], "next")

    plain = per_group(rows, ["k"], ["valid_from", "change_id"], work, hot_rows=None)
    cut = per_group(rows, ["k"], ["valid_from", "change_id"], work, **SMALL)
    assert same(plain, cut)
    assert plain.agg(F.max("n")).first()[0] > 300


def dims_and_facts(spark, seed):
    events = log(spark, seed)
    spec = scd2.Scd2(["k"], ["p"], tiebreak=["change_id"])
    dim = scd2.scd2(events.filter("change_id % 3 > 0"), spec, hot_rows=None)
    facts = events.filter("change_id % 3 = 0").select("change_id", "k", F.col("valid_from").alias("at"))
    return dim, facts


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_asof_equals_interval_join(spark, seed):
    dim, facts = dims_and_facts(spark, seed)
    args = (facts, dim, "k", "at", "k", ["version_key", "p"])
    expected = pit_join(*args)
    assert expected.count() == facts.count()
    assert same(expected, asof_join(*args, ["change_id"], hot_rows=None))
    assert same(expected, asof_join(*args, ["change_id"], **SMALL))
    assert same(expected, point_in_time(*args, ["change_id"]))


@pytest.mark.parametrize("versions", [3, 400])
def test_overlapping_windows_give_every_match_at_any_size(spark, versions):
    dim = spark.range(versions).selectExpr(
        "1L AS k", "timestamp_micros(id) AS valid_from", "CAST(NULL AS TIMESTAMP) AS valid_to", "id AS version_key"
    )
    fact = spark.sql("SELECT 7L AS f, 1L AS k, timestamp'2020-01-01' AS at")
    found = point_in_time(fact, dim, "k", "at", "k", ["version_key"], ["f"], disjoint=False)
    assert found.count() == versions


def test_asof_ends_with_the_window(spark):
    dim = spark.sql(
        "SELECT 1 AS k, 'v1' AS name, TIMESTAMP_NTZ'2026-01-01' AS valid_from, TIMESTAMP_NTZ'2026-01-05' AS valid_to"
    )
    facts = spark.sql("SELECT id AS n, 1 AS k, make_timestamp_ntz(2026, 1, int(id), 0, 0, 0) AS at FROM range(1, 9)")
    args = (facts, dim, "k", "at", "k", ["name"])
    assert same(pit_join(*args), asof_join(*args, ["n"]))
    assert pit_join(*args).filter("name IS NOT NULL").count() == 4


def test_version_delta_and_no_overlap(spark):
    dim = scd2.scd2(log(spark, 7), scd2.Scd2(["k"], ["p"], tiebreak=["change_id"]), hot_rows=None)
    dim = dim.withColumn("size", F.length(F.coalesce("p", F.lit(""))) + F.dayofmonth("valid_from"))
    ties = ["valid_to", "size", "p"]
    assert same(
        scd2.version_delta(dim, ["k"], "size", ties, hot_rows=None), scd2.version_delta(dim, ["k"], "size", ties, **SMALL)
    )
    assert same(
        quality.no_overlap(dim, "k", "e", ["p"], hot_rows=None), quality.no_overlap(dim, "k", "e", ["p"], **SMALL)
    )


@pytest.mark.parametrize(
    "deletes, null_safe", [("keep", False), ("keep", True), ("drop", False), ("close", False), ("close", True)]
)
def test_incremental_equals_full(spark, deletes, null_safe):
    rows = log(spark, 8)
    spec = scd2.Scd2(["k"], ["p", "q"], tiebreak=["change_id"], deletes=deletes, null_safe=null_safe)
    past = rows.filter("change_id < 300")
    existing = scd2.scd2(past, spec, None)
    batches = [
        "change_id >= 300 AND change_id < 330 OR change_id >= 330 AND k IS NULL",
        "change_id >= 330 AND k = 1 AND (valid_from > '2026-01-20' OR valid_from IS NULL)",
    ]
    for n, condition in enumerate(batches):
        new = rows.filter(condition)
        existing = scd2.scd2_update(existing, past, new, spec, **(SMALL if n == 1 else {"hot_rows": None}))
        existing = spark.createDataFrame(existing.collect(), existing.schema)
        past = past.unionByName(new)
        assert same(existing, scd2.scd2(past, spec, None)), condition


def test_order_of_arrival_does_not_matter(spark):
    rows = log(spark, 10)
    spec = scd2.Scd2(["k"], ["p", "q"], tiebreak=["change_id"])
    assert same(scd2.scd2(rows, spec), scd2.scd2(rows.orderBy(F.rand(1)).repartition(3), spec))


def overlapping(spark, seed, keys, facts, windows, span):
    """Random windows (empty, backward, open, equal, without key or start) and facts on and between their ends."""
    r = random.Random(seed)
    when = lambda: None if r.random() < 0.03 else r.randint(0, span)
    key = lambda: None if r.random() < 0.03 else r.randint(1, keys)
    dim = [(key(), when(), None if r.random() < 0.1 else r.randint(0, span), n) for n in range(windows)]
    dim += dim[:5]
    fact = [(n, key(), when(), "f") for n in range(facts)]
    ts = "timestamp_seconds({0} * 60)".format
    dim = spark.createDataFrame(dim, "k long, a long, b long, name long").selectExpr("k", f"{ts('a')} AS valid_from", f"{ts('b')} AS valid_to", "name")
    fact = spark.createDataFrame(fact, "id long, k long, at long, _place string").selectExpr("id", "k", f"{ts('at')} AS at", "_place")
    return fact, dim


@pytest.mark.parametrize("hot_rows", [None, 1, 40])
@pytest.mark.parametrize("shape", [(1, 3, 200, 60, 40), (2, 1, 150, 300, 2000), (3, 50, 300, 80, 10), (4, 2, 20, 0, 5), (5, 1, 30, 1, 9)])
def test_overlapping_windows_give_the_pairs_of_the_interval_join(spark, shape, hot_rows):
    fact, dim = overlapping(spark, *shape)
    limits = {} if hot_rows is None else {"chunk_rows": 17}
    want = joins.pit_join(fact, dim, "k", "at", "k", ["name"])
    got = joins.overlap_join(fact, dim, "k", "at", "k", ["name"], ["id"], hot_rows=hot_rows, **limits)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("narrow", [0, 4, 1000])
def test_narrow_and_wide_keys_of_overlapping_windows_give_the_same_rows(spark, monkeypatch, narrow):
    monkeypatch.setattr(joins, "NARROW", narrow)
    fact, dim = overlapping(spark, 6, 12, 200, 60, 40)
    attributes = ["name", "valid_to"]
    want = joins.pit_join(fact, dim.withColumn("ends", F.col("valid_to")), "k", "at", "k", ["name", "ends"])
    got = joins.overlap_join(fact, dim, "k", "at", "k", attributes, ["id"])
    assert got.columns == [*fact.columns, *attributes]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_narrow_keys_of_overlapping_windows_cross_one_exchange_a_side(spark):
    fact, dim = overlapping(spark, 7, 50, 300, 80, 10)
    plan = joins.overlap_join(fact, dim, "k", "at", "k", ["name"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Generate" not in plan


@pytest.mark.parametrize("narrow", [0, 20, 1000])
def test_items_take_the_version_of_their_time_whether_a_product_has_few_or_many(spark, monkeypatch, narrow):
    monkeypatch.setattr(joins, "NARROW", narrow)
    events = log(spark, 11).selectExpr("bigint(k) AS product_id", "p AS category", "double(change_id % 7) AS price", "q AS name", "valid_from", "valid_from AS captured_at", "change_id")
    dim = scd2.dim_products_scd2(events, hot_rows=None)
    dated = log(spark, 12).selectExpr(
        "change_id AS order_item_id", "1L AS order_id", "bigint(k) AS product_id", "2L AS customer_id", "valid_from AS order_date",
        "p AS status", "1 AS quantity", "1.5D AS unit_price", "1.5D AS item_subtotal",
    )
    found = facts.keyed_items(dated, dim, widths=events.select("product_id"))
    assert same(facts.keyed_items(dated, dim, "interval"), found)
    assert found.filter("product_key IS NOT NULL").count() > 100
    if narrow == 1000:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("Window [") <= 2


def test_shuffle_files_of_a_stored_step_are_dropped(spark, tmp_path):
    def shuffled():
        blocks = spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
        return {name for i in range(blocks.size()) if (name := blocks.apply(i).name()).startswith("shuffle")}

    before = shuffled()
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/rows")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 1000
    assert spark.range(1000).repartition(3, "id").count() == 1000 and shuffled() - before


def test_a_hot_key_costs_its_matches(spark):
    """One key, 10,000 versions and 10,000 facts: the join makes as many rows as there are matches."""
    dim = spark.range(10_000).selectExpr(
        "1L AS k", "timestamp_seconds(id * 100) AS valid_from", "timestamp_seconds(id * 100 + 300) AS valid_to", "id AS name"
    )
    fact = spark.range(10_000).selectExpr("id", "1L AS k", "timestamp_seconds(id * 100 + 60) AS at")
    found = joins.overlap_join(fact, dim, "k", "at", "k", ["name"], ["id"])
    assert found.count() == 3 * 10_000 - 3
    rows = joined_rows(found)
    assert rows and max(rows) <= 60_000, rows


def joined_rows(df):
    """Output rows of every join of an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        metrics = node.metrics()
        if "Join" in name and metrics.contains("numOutputRows"):
            out.append(metrics.apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_hot_groups_are_counted_from_the_given_sizes(spark):
    """Counting neither runs the rows, which fail here if run, nor changes them: a key may be named more often than it is."""
    rows = log(spark, 5)
    broken = rows.withColumn("change_id", F.raise_error(F.lit("run for a count")).cast("long"))
    named = rows.select("k").union(rows.select("k"))
    work = lambda groups: groups.number("n")
    assert per_group(broken, ["k"], ["valid_from", "change_id"], work, hot_rows=10_000, sizes=named).columns[-1] == "n"
    plain = per_group(rows, ["k"], ["valid_from", "change_id"], work, hot_rows=None)
    assert same(plain, per_group(rows, ["k"], ["valid_from", "change_id"], work, sizes=named, **SMALL))


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_digests_do_not_cross_the_exchange_of_the_asof_join(spark, hot_rows):
    events = spark.range(300).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 7).alias("k"), F.expr("timestamp_seconds(id * 100)").alias("at"),
        (F.col("id") % 3).cast("int").alias("price"), F.col("id").alias("n"),
    )
    dim = scd2.scd2(events, scd2.Scd2(keys=["k"], tracked=["price"], valid_from="at", tiebreak=["n"], key_name="price_key"))
    facts = spark.range(200).select("id", F.when(F.col("id") % 40 != 0, (F.col("id") % 9).cast("int")).alias("item"), F.expr("timestamp_seconds(id * 149 - 5)").alias("ts"))
    given = facts, dim, "item", "ts", "k", ["price", "price_key"], ["id"]
    expected = pit_join(*given[:-1])
    found = point_in_time(*given, method="asof", key_attribute="price_key", hot_rows=hot_rows, chunk_rows=10)
    assert same(expected, found) and expected.where("price_key is not null").count() > 50
    if hot_rows is None:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "md5(" in plan and "md5(" not in plan[plan.index("Window") :]
