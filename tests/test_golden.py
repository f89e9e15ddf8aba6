"""Fixtures with known results: seed, point in time, mutation, bad data, edge log."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronomart.operators import marts, quality, scd2, staging
from chronomart.operators.joins import resolve
from chronomart.plans import retail
from tests import seed as s


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("seed"))
    return retail.run_warehouse(s.seed().frame(spark), path)


def test_daily_mart(built):
    rows = [(str(r[0]), *r[1:]) for r in built["agg_daily_sales"].collect()]
    assert sorted(rows) == s.daily_rows()


def test_kpis(built):
    row = marts.kpis(built["fct_orders"]).first()
    orders = s.orders()
    cents = sum(c for *_, c, _ in orders)
    assert tuple(row) == (100, cents / 100, s.half_up(cents, 100) / 100, 200, sum(u for *_, u in orders), len({o[1] for o in orders}))


def test_status_breakdown(built):
    rows = {r["status"]: (r["count"], r["revenue"], r["share_pct"]) for r in marts.status_breakdown(built["fct_orders"]).collect()}
    of = {state: [o for o in s.orders() if o[3] == state] for state in s.STATES}
    assert rows == {state: (len(own), sum(c for *_, c, _ in own) / 100, float(len(own))) for state, own in of.items()}


def test_dimensions_and_keys(built):
    assert built["dim_customers_scd2"].filter("is_current").count() == 50
    assert built["dim_products_scd2"].filter("is_current").count() == 30
    missing = built["fct_orders"].filter("customer_key IS NULL").collect()
    # Customers are known from 8 o'clock of the first day on.
    early = [(i, buyer) for i, buyer, at, *_ in s.orders() if at < datetime(2026, 8, 1, 8)]
    assert sorted((r["order_id"], r["customer_id"]) for r in missing) == early != []


def test_latest_days_newest_first(built):
    days = [str(r["sale_date"]) for r in marts.latest_days(built["agg_daily_sales"], 5).collect()]
    assert days == ["2026-08-17", "2026-08-16", "2026-08-15", "2026-08-14", "2026-08-13"]


def test_point_in_time(spark):
    log = s.seed()
    log.insert("orders", s.order(101, 1, "2026-08-10T12:00:00+00:00", "delivered", 199.99))
    log.insert("order_items", s.item(201, 101, 1, 1))
    moved = "2026-08-20T10:00:00+00:00"
    log.add("customers", "update", s.customer(1), s.customer(1, address="New Street", updated_at=moved))
    log.insert("orders", s.order(102, 1, "2026-08-25T15:00:00+00:00", "shipped", 349.50))
    log.insert("order_items", s.item(202, 102, 2, 1))
    out = retail.build(log.frame(spark))
    dim = out["dim_customers_scd2"]
    versions = [tuple(r) for r in scd2.history(dim, "customer_id", 1).select("customer_key", "valid_from", "valid_to", "is_current").collect()]
    change = datetime(2026, 8, 20, 10)
    assert versions == [
        ("cf772a031a6cbda64e1c0eee50d92ee4", datetime(2026, 8, 1, 8), change, False),
        ("565146295d84f11803172047020a4190", change, None, True),
    ]
    facts = out["fct_orders"].filter(F.col("order_id").isin(101, 102))
    found = {r["order_id"]: (r["address"], r["is_current"]) for r in resolve(facts, dim, "customer_key", ["address", "is_current"]).collect()}
    assert found == {101: ("1 First Street", False), 102: ("New Street", True)}


def test_mutation_keeps_history(spark):
    log = s.seed()
    before = retail.build(log.frame(spark))
    counts = {n: before[n].count() for n in ("dim_customers_scd2", "dim_products_scd2")}
    now = "2026-09-01T00:00:00+00:00"
    log.add("customers", "update", s.customer(1), s.customer(1, address="9 Validation", updated_at=now), now)
    log.add("products", "update", s.product(1), s.product(1, price=224.99, updated_at=now), now)
    after = retail.build(log.frame(spark))
    for name, key in (("dim_customers_scd2", "customer_id"), ("dim_products_scd2", "product_id")):
        assert after[name].count() == counts[name] + 1
        old, new = scd2.history(after[name], key, 1).collect()
        assert old["valid_to"] == datetime(2026, 9, 1) and old["is_current"] is False
        assert new["valid_from"] == datetime(2026, 9, 1) and new["valid_to"] is None and new["is_current"] is True


def bad_log():
    log = s.seed()
    now = "2026-09-01T00:00:00+00:00"
    log.add("products", "update", s.product(5), s.product(5, price=-49.99, updated_at=now), now)
    log.insert("orders", s.order(99901, 1, now, "fraudulent_charge", 150.00), now)
    log.insert("orders", s.order(99902, 999999, now, "pending", 89.99), now)
    return log


def test_bad_data_closes_the_gate(spark, tmp_path):
    log = bad_log().frame(spark)
    results = {(r["suite"], r["expectation"], r["column"]): r["violations"] for r in retail.source_quality(log).collect()}
    found = {k: v for k, v in results.items() if v}
    assert found == {
        ("products", "between", "price"): 1,
        ("orders", "in_set", "status"): 1,
        ("orders", "references", "customer_id"): 1,
    }
    with pytest.raises(quality.GateClosed):
        retail.run_warehouse(log, str(tmp_path / "halted"))
    assert not (tmp_path / "halted").exists()


def test_bad_data_quarantine_leaves_clean_events(spark):
    views = retail.validation_views(bad_log().frame(spark))
    clean, bad = quality.quarantine(views["orders"], quality.SOURCE_SUITES["orders"], views)
    assert clean.count() == 100
    assert {r["order_id"]: r["_failed"] for r in bad.collect()} == {
        "99901": ["in_set(status)"], "99902": ["references(customer_id)"],
    }


def test_edge_log(spark):
    log = s.Log()
    log.insert("customers", s.customer(1, address="A", updated_at="2026-01-01 00:00:00"))
    log.add("customers", "update", None, s.customer(1, address="A", updated_at="2026-01-02T00:00:00Z"))
    log.add("customers", "update", None, s.customer(1, address="B", updated_at="2026-01-03T01:00:00+01:00"))
    log.add("customers", "update", None, s.customer(1, address=None, updated_at="2026-01-04 00:00:00"))
    log.add("customers", "update", None, s.customer(1, address="C", updated_at="2026-01-05 00:00:00"))
    log.add("customers", "delete", s.customer(1, address="C", updated_at="2026-01-05 00:00:00"), None)
    events = staging.stg_customers(staging.stage_customers(log.frame(spark)))
    rows = scd2.dim_customers_scd2(events).orderBy("valid_from").collect()
    assert [(r["address"], r["valid_from"].day, r["is_current"]) for r in rows] == [("A", 1, False), ("B", 3, False), ("C", 5, True)]


def test_rerun_gives_the_same_tables(spark, tmp_path):
    log = s.seed().frame(spark)
    runs = iter(["one", "two"])
    names = ["dim_customers_scd2", "fct_orders", "fct_order_items", "agg_daily_sales", "stg_orders"]
    found = retail.prove_idempotent(lambda: retail.run_warehouse(log, str(tmp_path / next(runs))), names)
    assert found == {n: (0, 0) for n in names}
