"""Streams against their batch form."""

import random

import pytest
from pyspark.sql import functions as F

from chronomart.operators import marts, quality
from chronomart.operators.diff import diff_counts
from chronomart.plans import retail, roles
from chronomart.plans.catalog import event_stream
from chronomart.schemas import ENVELOPE
from chronomart.sources import changelog
from chronomart.sources.changelog import list_folder
from chronomart.sources.scratch import shared_dir
from chronomart.streaming.ingest import ONCE, append_new, dedupe_stream, gate_batch, ingest_stream
from chronomart.streaming.maintain import IncrementalWarehouse, maintain_stream
from chronomart.streaming.windows import daily_sales_stream, read_windows, start_windows
from tests import seed as s


def same(left, right):
    return tuple(diff_counts(left, right.select(*left.columns)).first()) == (0, 0)


def finish(*queries):
    for query in queries:
        query.awaitTermination()


def test_ingest_survives_restart(spark, tmp_path):
    source, bronze = tmp_path / "in", str(tmp_path / "bronze")
    rows = s.seed().frame(spark).select(F.to_json(F.struct("*")).alias("value"))

    def deliver(condition):
        rows.filter(condition).coalesce(1).write.mode("append").text(str(source))

    def run():
        text = spark.readStream.text(str(source))
        finish(*ingest_stream(text, bronze, str(tmp_path / "ckpt"), str(tmp_path / "bad"), trigger=ONCE))

    deliver("value LIKE '%products%'")
    run()
    run()
    first = changelog.read_changes(spark, bronze).count()
    deliver("value NOT LIKE '%products%'")
    (source / "broken.txt").write_text("{broken\n" + '{"table": "orders", "operation": "X", "captured_at": "now"}\n')
    run()
    assert first == 30
    assert changelog.read_changes(spark, bronze).count() == 410
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_dedupe_across_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    log = s.seed().frame(spark)
    no_id = log.filter("change_id <= 3").withColumn("change_id", F.lit(None).cast("bigint"))
    log.coalesce(1).write.parquet(source)
    log.filter("table = 'orders'").unionByName(no_id).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(source)
    query = dedupe_stream(stream, "30 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    finish(query.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(**ONCE).start())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 413


def test_append_new_is_exact_however_late(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    log = s.seed().frame(spark)
    no_id = log.filter("change_id <= 3").withColumn("change_id", F.lit(None).cast("bigint"))
    run = append_new(bronze)
    run(log.filter("change_id > 100"), 0)
    run(log.filter("change_id > 100"), 0)
    run(log.filter("change_id <= 200").unionByName(no_id), 1)
    run(log, 2)
    stored = changelog.read_changes(spark, bronze)
    assert stored.count() == 413
    assert stored.select("change_id").distinct().count() == 411


def test_gate_repeats_a_batch_in_place(spark, tmp_path):
    batch = spark.createDataFrame([(1, 5), (2, -5)], "id int, price int")
    gate = gate_batch([quality.Between("price", 0)], str(tmp_path / "ok"), str(tmp_path / "bad"))
    for _ in range(2):
        gate(batch, 0)
    gate(batch, 1)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 2
    assert spark.read.parquet(str(tmp_path / "bad")).filter("batch_id = 1").first()["_failed"] == ["between(price)"]


def test_daily_window(spark, tmp_path):
    fct = retail.build(s.seed().frame(spark))["fct_orders"].drop("customer_key")
    source = str(tmp_path / "facts")
    fct.filter("order_id % 2 = 0").coalesce(1).write.parquet(source)
    fct.filter("order_id % 2 = 1").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(fct.schema).option("maxFilesPerTrigger", 1).parquet(source)
    finish(start_windows(daily_sales_stream(stream, "60 days"), str(tmp_path / "out"), str(tmp_path / "ckpt"), ONCE))
    assert same(marts.daily_sales(fct), read_windows(spark, str(tmp_path / "out")))


NAMES = [
    "dim_customers_scd2", "dim_products_scd2", "fct_orders", "fct_order_items", "agg_daily_sales",
    "stg_customers", "stg_products", "stg_orders", "stg_order_items", "stg_inventory",
]


def busy_log(spark, seed):
    """The seed plus random updates: moves, prices, states, items that change order, late times."""
    rnd, log = random.Random(seed), s.seed()
    for n in range(80):
        day = f"2026-{rnd.choice(['07', '08', '09'])}-{rnd.randint(1, 28):02d}T0{rnd.randint(0, 9)}:00:00+00:00"
        kind = rnd.choice(["customer", "product", "order", "item", "delete"])
        i = rnd.randint(1, 12)
        if kind == "customer":
            log.add("customers", "update", None, s.customer(i, address=f"{rnd.randint(1, 3)} Road", updated_at=day), day)
        elif kind == "product":
            log.add("products", "update", None, s.product(i, price=rnd.randint(1, 5), updated_at=day), day)
        elif kind == "order":
            date = f"2026-08-{rnd.randint(1, 28):02d}T06:00:00+00:00"
            log.add("orders", "update", None, s.order(i, rnd.randint(1, 12), date, rnd.choice(s.STATES), 10 * n), day)
        elif kind == "item":
            log.add("order_items", "update", None, s.item(i, rnd.randint(1, 12), rnd.randint(1, 30), n), day)
        else:
            log.add("order_items", "delete", s.item(i, rnd.randint(1, 12), 1, 1), None, day)
    log.insert("products", {"product_id": 1, "price": "free"})
    log.add("orders", "merge", None, s.order(1, 1, s.BASE, "pending", 1))
    return log.frame(spark)


def test_incremental_warehouse_equals_full_build(spark, tmp_path):
    log = busy_log(spark, 1)
    warehouse = IncrementalWarehouse(spark, str(tmp_path), file_rows=50)
    cuts = [0, 400, 10_000]
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        warehouse.apply(log.filter(f"change_id > {low} AND change_id <= {high}"), n)
    good = log.filter("operation <> 'merge' AND NOT coalesce(after['price'] = 'free', false)")
    full = retail.build(good)
    got = warehouse.tables()
    for name in NAMES:
        assert same(full[name], got[name]), name
    assert spark.read.parquet(str(tmp_path / "quarantine/products")).count() == 1
    assert spark.read.parquet(str(tmp_path / "quarantine/envelope")).count() == 1


def test_batch_that_fails_half_way_is_repeated(spark, tmp_path):
    """An order changes its day, an item its order; the batch dies before facts, then before days."""

    class Dying(IncrementalWarehouse):
        before = None

        def _write(self, state, table, rows, gone=None):
            if table == self.before:
                raise RuntimeError(table)
            super()._write(state, table, rows, gone)

    log = s.seed()
    size = len(log.rows)
    late = "2026-09-01T00:00:00+00:00"
    log.add("orders", "update", None, s.order(7, 50, "2026-12-24T00:00:00+00:00", "pending", 10), late)
    log.add("order_items", "update", None, s.item(21, 60, 4, 3), late)
    log = log.frame(spark)
    warehouse = Dying(spark, str(tmp_path))
    warehouse.apply(log.filter(f"change_id <= {size}"), 0)
    batch = log.filter(f"change_id > {size}")
    for warehouse.before in ("fct_orders", "sales_parts"):
        with pytest.raises(RuntimeError, match=warehouse.before):
            warehouse.apply(batch, 1)
    warehouse.before = None
    warehouse.apply(batch, 1)
    committed = warehouse.store.current()
    warehouse.apply(batch, 1)
    assert warehouse.store.current() == committed
    full, got = retail.build(log), warehouse.tables()
    for name in ("fct_orders", "fct_order_items", "agg_daily_sales", "stg_order_items"):
        assert same(full[name], got[name]), name


def test_maintain_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    log = s.seed().frame(spark)
    log.coalesce(1).write.parquet(source)
    warehouse = IncrementalWarehouse(spark, str(tmp_path / "wh"))
    stream = spark.readStream.schema(ENVELOPE).parquet(source)
    finish(maintain_stream(stream, warehouse.apply, str(tmp_path / "ckpt"), ONCE))
    rows = [(str(r[0]), *r[1:]) for r in warehouse.tables()["agg_daily_sales"].collect()]
    assert sorted(rows) == s.daily_rows()


def test_roles_cover_whole_tables(spark, sf):
    log = roles.retail_log(spark, sf)
    expected = {
        "customers": ("customer", "orders"), "products": ("part", "lineitem"), "orders": ("orders", "orders"),
        "order_items": ("lineitem",), "inventory": ("lineitem",),
    }
    rows = {r["table"]: r["count"] for r in log.groupBy("table").count().collect()}
    assert rows == {k: sum(roles.table(spark, sf, t).count() for t in v) for k, v in expected.items()}


def test_bronze_holds_stream_and_batch(spark, tmp_path):
    source, bronze = tmp_path / "in", str(tmp_path / "bronze")
    log = s.seed().frame(spark)
    log.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(str(source))
    text = spark.readStream.text(str(source))
    finish(*ingest_stream(text, bronze, str(tmp_path / "ckpt"), str(tmp_path / "bad"), trigger=ONCE))
    changelog.write_bronze(log.filter("table = 'orders'"), bronze)
    assert changelog.read_changes(spark, bronze).count() == 510


def test_late_facts_update_their_day(spark, tmp_path):
    fct = retail.build(s.seed().frame(spark))["fct_orders"].drop("customer_key")
    source = str(tmp_path / "facts")
    late = fct.filter("order_id % 2 = 1").withColumn("order_date", F.expr("order_date - interval 400 days"))
    fct.filter("order_id % 2 = 0").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(fct.schema).parquet(source)
    for _ in range(2):
        finish(start_windows(daily_sales_stream(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"), ONCE))
        late.coalesce(1).write.mode("overwrite").parquet(f"{source}/late")
        stream = spark.readStream.schema(fct.schema).option("recursiveFileLookup", True).parquet(source)
    assert same(marts.daily_sales(fct.filter("order_id % 2 = 0").unionByName(late)), read_windows(spark, str(tmp_path / "out")))


def test_unreadable_stamp_is_stored_once(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    log = s.seed().frame(spark).filter("change_id <= 2").withColumn("captured_at", F.lit("soon"))
    for n in range(2):
        append_new(bronze)(log, n)
    assert [str(r[0]) for r in changelog.read_changes(spark, bronze).select("event_date").collect()] == ["1970-01-01"] * 2


def test_event_stream_reads_a_folder_of_part_files(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/events.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    query = event_stream(spark, str(tmp_path)).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    finish(query.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(**ONCE).start())
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_a_batch_leaves_nothing_behind_but_the_warehouse(spark, tmp_path):
    kept = lambda: {n for n in list_folder(spark, shared_dir(spark)) if n.startswith("batch-")}
    before, checkpoints = kept(), spark.sparkContext._jsc.sc().getCheckpointDir()
    held = lambda: set(list_folder(spark, checkpoints.get())) if checkpoints.isDefined() else set()
    stored = held()
    warehouse = IncrementalWarehouse(spark, str(tmp_path / "wh"))
    warehouse.apply(roles.retail_log(spark, "/root/testdata/sf0.001").filter("change_id % 7 = 0"), 0)
    assert warehouse.tables()["fct_orders"].count() > 0
    assert kept() == before and held() == stored
