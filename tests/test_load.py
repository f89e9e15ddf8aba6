"""One pass over the log: gate, good rows, bad rows with their reasons."""

import pytest
from pyspark.sql import functions as F

from chronomart.operators import envelope, errors, quality
from chronomart.plans import retail
from chronomart.schemas import ENVELOPE
from tests import seed as s

NOW = "2026-09-01T00:00:00+00:00"


def broken_log(spark):
    """The seed, and one event for each thing that can't be read; none of them closes the gate."""
    log = s.seed()
    log.add("orders", "c", None, s.order(501, 1, NOW, "pending", 5), NOW)
    log.add("orders", "update", None, {**s.order(7, 7, NOW, "pending", 1), "total_amount": "12,50"}, NOW)
    log.add("orders", "u", None, {**s.order(8, 8, NOW, "pending", 1), "order_date": "soon"}, NOW)
    log.add("order_items", "update", None, {**s.item(3, 1, 1, 1), "order_id": "one", "quantity": "many"}, NOW)
    log.add("inventory", "update", None, {"product_id": "1", "stock_level": None}, NOW)
    log.add("orders", "merge", None, s.order(9, 1, NOW, "pending", 1), NOW)
    log.add("orders", "update", None, s.order(10, 1, NOW, "pending", 1), "yesterday")
    log.add(None, "update", None, {"a": "b"}, NOW)
    return log.frame(spark)


WANT = {
    ("orders", "unreadable", "total_amount", "12,50"), ("orders", "unreadable", "order_date", "soon"),
    ("order_items", "unreadable", "order_id", "one"), ("order_items", "unreadable", "quantity", "many"),
    ("inventory", "unreadable", "stock_level", None), ("orders", "unknown", "operation", "merge"),
    ("orders", "unreadable", "captured_at", "yesterday"), (None, "missing", "table", None),
}


def test_bad_rows_are_set_aside_with_their_reasons(spark, tmp_path):
    log = broken_log(spark)
    tables = retail.run_warehouse(log, str(tmp_path / "wh"))
    bad = spark.read.parquet(str(tmp_path / "wh/quarantine"))
    assert {tuple(r) for r in bad.select("table", F.inline("_errors")).collect()} == WANT and bad.count() == 7
    assert sum(r["events"] for r in errors.error_counts(bad).collect()) == 8
    good = log.filter("change_id <= 410 OR operation = 'c'")
    full = retail.build(good.withColumn("operation", envelope.normalize_op(F.col("operation"))))
    for name in ("fct_orders", "stg_orders", "stg_order_items", "stg_inventory", "agg_daily_sales"):
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, full[name].collect())), name
    assert tables["stg_orders"].filter("total_amount IS NULL OR order_date IS NULL").isEmpty()
    assert [p.name for p in tmp_path.iterdir()] == ["wh"]


def test_the_gate_reads_what_the_pass_counted(spark, tmp_path):
    log = broken_log(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    n = log.count()
    watched = log.withColumn("captured_at", counted.asNondeterministic()("captured_at"))
    loaded = retail.load_log(watched, str(tmp_path / "load"), retail.ALL_SUITES)
    assert seen.value == n
    results = loaded.results.unionByName(retail.reference_results(loaded.good, retail.ALL_SUITES))
    slow = retail.source_quality(log, retail.ALL_SUITES)
    key = lambda r: (r["suite"], r["expectation"], r["column"])
    fast = {key(r): r["violations"] for r in results.collect()}
    assert {key(r): r["violations"] for r in slow.collect()} == fast and len(fast) == 13
    assert seen.value == n


def test_a_closed_gate_leaves_nothing(spark, tmp_path):
    log = s.seed()
    log.add("products", "update", s.product(5), s.product(5, price=-1, updated_at=NOW), NOW)
    with pytest.raises(quality.GateClosed, match="products.price between: 1 of"):
        retail.run_warehouse(log.frame(spark), str(tmp_path / "wh"))
    assert list(tmp_path.iterdir()) == []


def test_malformed_connector_text_is_kept(spark):
    texts = ['{"op": "c", "after": {"a": "1"}, "source": {"table": "t", "lsn": 1}, "ts_ms": 0}', "{broken", "[1]", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    log = envelope.from_connector(df, keep_malformed=True)
    assert [r["_corrupt_record"] for r in log.collect()] == [None, "{broken", "[1]"]
    assert envelope.from_connector(df).columns == ENVELOPE.fieldNames()
    told = errors.with_errors(log).filter(F.size("_errors") > 0).select(F.inline("_errors")).collect()
    assert [tuple(r) for r in told] == [("malformed", None, "{broken"), ("malformed", None, "[1]")]


def test_history_kept(spark):
    dim = spark.sql("""SELECT * FROM VALUES (1, DATE'2026-01-01', DATE'2026-02-01', 'a'), (1, DATE'2026-02-01', NULL, 'b'),
      (2, DATE'2026-01-01', NULL, 'a') AS t(id, valid_from, valid_to, x)""")
    later = spark.sql("""SELECT * FROM VALUES (1, DATE'2026-01-01', DATE'2026-02-01', 'a'), (1, DATE'2026-02-01', DATE'2026-03-01', 'b'),
      (1, DATE'2026-03-01', NULL, 'c'), (2, DATE'2026-01-01', NULL, 'z'), (3, DATE'2026-01-01', NULL, 'n') AS t(id, valid_from, valid_to, x)""")
    rows = lambda a, b: sorted(tuple(r) for r in retail.history_kept(a, b, ["id"], ["x"]).collect())
    assert rows(dim, later) == [(1, 2, 3, 0), (2, 1, 1, 1), (3, 0, 1, 0)]
    moved = dim.withColumn("valid_to", F.expr("CASE WHEN x = 'a' AND id = 1 THEN DATE'2026-01-20' ELSE valid_to END"))
    assert rows(dim, moved) == [(1, 2, 2, 1), (2, 1, 1, 0)]
