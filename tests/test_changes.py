"""Envelope, payload, staging, bronze and diff operators."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronomart.functions.money import mean_money, percent, round_money
from chronomart.functions.payload import contains, normalize_op
from chronomart.functions.times import capture_date, parse_ts
from chronomart.operators import diff, envelope, latest, staging
from chronomart.schemas import ENVELOPE
from chronomart.sources import changelog
from tests import seed as s

TEXTS = [
    ("2026-08-01T08:00:00+00:00", datetime(2026, 8, 1, 8)),
    ("2026-08-01 08:00:00", datetime(2026, 8, 1, 8)),
    ("2026-08-01T08:00:00Z", datetime(2026, 8, 1, 8)),
    ("2026-08-01T08:00:00.25-02:30", datetime(2026, 8, 1, 10, 30, 0, 250000)),
    ("2026-08-01", datetime(2026, 8, 1)),
    ("yesterday", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_ts_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(TEXTS, "text string, expected timestamp_ntz")
        rows = df.select("expected", parse_ts(F.col("text")).alias("got")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["got"] for r in rows] == [r["expected"] for r in rows]


def test_capture_date_keeps_own_offset(spark):
    df = spark.createDataFrame([("2026-08-01T23:30:00-05:00",), ("2026-08-02T00:30:00+05:00",), ("soon",)], "t string")
    found = [r[0] for r in df.select(capture_date(F.col("t"))).collect()]
    assert found[:2] == [date(2026, 8, 1), date(2026, 8, 2)]
    assert found[2] is not None


def test_normalize_op(spark):
    df = spark.createDataFrame([(x,) for x in ("c", "U", "d", "insert", "merge", None)], "op string")
    assert [r[0] for r in df.select(normalize_op(F.col("op"))).collect()] == [
        "insert", "update", "delete", "insert", "merge", None,
    ]


def test_money(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.125,), (0.1,), (None,)], "x double")
    assert [r[0] for r in df.select(round_money(F.col("x"))).collect()] == [1.0, 2.68, -1.13, 0.1, None]
    row = df.agg(mean_money(F.col("x")), percent(F.count("x"), F.lit(0).cast("bigint"))).first()
    assert row[0] == 0.66 and row[1] is None


def test_contains_is_false_for_null(spark):
    df = spark.createDataFrame([("a@b",), ("ab",), (None,)], "x string")
    assert [r[0] for r in df.select(contains(F.col("x"), "@")).collect()] == [True, False, False]


def event(**parts):
    return json.dumps({"table": "orders", "operation": "insert", "captured_at": s.BASE} | parts)


def test_parse_and_validate(spark):
    texts = [
        event(after={"order_id": 1, "total_amount": "12.50", "note": None}, change_id=1),
        event(operation="U"), event(operation="d", before={"order_id": 2}), event(table=None),
        event(captured_at=None), event(operation="merge"), "{broken", "   ",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = envelope.validate_envelope(envelope.parse_envelope(df))
    rows = good.collect()
    assert [r["operation"] for r in rows] == ["insert", "delete"]
    assert rows[0]["after"] == {"order_id": "1", "total_amount": "12.50", "note": None}
    assert rows[0]["before"] is None and rows[1]["after"] is None
    assert bad.count() == 5
    assert bad.filter("_corrupt_record IS NOT NULL").count() == 1


def test_each_text_is_parsed_once(spark):
    df = spark.createDataFrame([(event(),)], "value string")
    good, _ = envelope.validate_envelope(envelope.parse_envelope(df))
    plan = envelope.payload(good)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_payload_rules(spark):
    rows = [
        ("t", "insert", None, {"a": "1"}, s.BASE, 1), ("t", "update", {"a": "1"}, {}, s.BASE, 2),
        ("t", "delete", {"a": "3"}, None, s.BASE, 3), ("t", "delete", {}, {}, s.BASE, 4),
        ("t", "delete", None, None, s.BASE, 5),
    ]
    found = envelope.payload(spark.createDataFrame(rows, ENVELOPE)).collect()
    assert {r["change_id"]: r["payload"] for r in found} == {1: {"a": "1"}, 2: {"a": "1"}, 3: {"a": "3"}}


def test_invariants(spark):
    rows = [
        ("t", "c", {"a": "1"}, {"a": "1"}, s.BASE, 1), ("t", "insert", None, None, s.BASE, 2),
        ("t", "update", None, {"a": "1"}, s.BASE, 3), ("t", "d", None, {"a": "1"}, s.BASE, 4),
    ]
    found = {r["operation"]: r for r in envelope.check_invariants(spark.createDataFrame(rows, ENVELOPE)).collect()}
    assert (found["insert"]["insert_with_before"], found["insert"]["insert_without_after"]) == (1, 1)
    assert found["update"]["update_without_before"] == 1
    assert (found["delete"]["delete_with_after"], found["delete"]["delete_without_before"]) == (1, 1)


def test_connector_messages(spark):
    body = {"before": None, "after": {"id": 1, "price": 2.5}, "source": {"table": "products", "lsn": 9}, "op": "u", "ts_ms": 1785571200123}
    texts = [json.dumps(body), json.dumps({"schema": {}, "payload": body | {"op": "r"}}), None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = envelope.from_connector(df).collect()
    assert [r["operation"] for r in rows] == ["update", "insert"]
    assert {r["captured_at"] for r in rows} == {"2026-08-01T08:00:00.123+00:00"}
    assert rows[1]["after"] == {"id": "1", "price": "2.5"} and rows[1]["change_id"] == 9
    kept = envelope.from_connector(df, snapshot_op=None)
    assert envelope.validate_envelope(kept)[1].count() == 1


def test_staging_defaults_and_unreadable(spark):
    log = s.Log()
    log.insert("order_items", {"order_item_id": "7.0", "order_id": 1, "product_id": 2})
    log.insert("order_items", {"order_item_id": 8, "order_id": 1, "product_id": 2, "quantity": None, "unit_price": "x"})
    log.insert("order_items", {"order_item_id": 9, "order_id": 1, "product_id": 2, "quantity": "3.9", "unit_price": "1.5"})
    log.insert("customers", {"customer_id": 1, "updated_at": ""}, "2026-02-03T04:05:06Z")
    df = log.frame(spark)
    rows = {r["order_item_id"]: (r["quantity"], r["unit_price"]) for r in staging.stage_order_items(df).collect()}
    assert rows == {7: (1, 0.0), 8: (None, None), 9: (3, 1.5)}
    assert [r["change_id"] for r in staging.unreadable(df, "order_items").collect()] == [2]
    person = staging.stage_customers(df).first()
    assert person["valid_from"] == person["captured_at"] == datetime(2026, 2, 3, 4, 5, 6)
    assert person["updated_at"] is None and person["name"] is None


def test_latest_state_keeps_or_drops_deletes(spark):
    log = s.Log()
    log.insert("orders", s.order(1, 1, s.BASE, " Pending ", 5))
    log.add("orders", "update", None, s.order(1, 1, s.BASE, "SHIPPED", 5))
    log.insert("orders", s.order(2, 1, s.BASE, "pending", 5))
    log.add("orders", "delete", s.order(2, 1, s.BASE, "pending", 5), None)
    staged = staging.stage_orders(log.frame(spark))
    assert {r["order_id"]: r["status"] for r in staging.stg_orders(staged).collect()} == {1: "shipped", 2: "pending"}
    assert [r["order_id"] for r in staging.stg_orders(staged, "drop").collect()] == [1]


def test_dedupe_keeps_events_without_id(spark):
    rows = [("t", "c", None, {"a": "1"}, s.BASE, i) for i in (1, 1, 2, None, None)]
    assert envelope.dedupe(spark.createDataFrame(rows, ENVELOPE)).count() == 4


def test_change_stats(spark):
    rows = {(r["breakdown"], r["table"], r["operation"]): r["events"] for r in envelope.change_stats(s.seed().frame(spark)).collect()}
    assert rows[("total", None, None)] == 410
    assert rows[("operation", None, "insert")] == 410
    assert rows[("table", "order_items", None)] == 200
    assert len(rows) == 7


def test_bronze_round_trip(spark, tmp_path):
    path, log = str(tmp_path / "bronze"), s.seed().frame(spark)
    assert changelog.read_changes(spark, path).count() == 0
    changelog.write_bronze(log, path)
    changelog.write_bronze(log.filter("table = 'products'"), path)
    assert changelog.read_changes(spark, path).count() == 440
    one = changelog.read_changes(spark, path, "products")
    assert one.count() == 60
    assert "PartitionFilters: [isnotnull(table" in one._jdf.queryExecution().executedPlan().toString()
    assert {str(r[0]) for r in one.select("event_date").distinct().collect()} == {"2026-08-01"}


def write_lines(folder, lines):
    folder.mkdir(parents=True)
    (folder / "2026-08-01.jsonl").write_text("\n".join(lines) + "\n")


def test_json_lines(spark, tmp_path):
    write_lines(tmp_path / "orders", [event(change_id=1), "", event(change_id=2, after={"a": 1})])
    write_lines(tmp_path / "products", [event(table="products", change_id=3), "{broken"])
    path = str(tmp_path)
    assert changelog.read_changes(spark, path, "orders", fmt="json").count() == 2
    assert changelog.read_changes(spark, path, "inventory", fmt="json").count() == 0
    with pytest.raises(Exception, match="(?i)malformed"):
        changelog.read_changes(spark, path, fmt="json").collect()
    good, bad = envelope.validate_envelope(changelog.read_changes(spark, path, fmt="json", malformed="keep"))
    assert (good.count(), bad.count()) == (3, 1)


def test_incremental_scan(spark):
    log = s.seed().frame(spark)
    assert changelog.high_water_mark(log) == 410
    assert changelog.read_changes_since(log, 400).count() == 10
    assert changelog.high_water_mark(log.filter("false")) == 0


def test_raw_events_and_refresh(spark, tmp_path):
    log = s.seed().frame(spark)
    changelog.write_raw_events(log, str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert raw.filter("loaded_at IS NULL OR after_state IS NULL").count() == 0
    back = envelope.from_change_table(raw)
    assert tuple(diff.diff_counts(
        staging.stage_orders(log), staging.stage_orders(back)).first()) == (0, 0)
    path = str(tmp_path / "staged")
    changelog.refresh(staging.stage_orders(log), path)
    assert changelog.refresh(staging.stage_orders(log), path).count() == 100


def test_materialize(spark, tmp_path):
    rows = spark.range(3)
    assert changelog.materialize(rows, "three_view", "view").count() == 3
    assert changelog.materialize(rows, "three_table", "table", str(tmp_path / "t")).count() == 3
    assert changelog.read_table(spark, "nothing_here") is None
    assert changelog.read_table(spark, "three_view").count() == 3


def test_source_from_parquet_has_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "inventory")
    spark.sql("SELECT 1 AS product_id, 'W' AS warehouse_id, 5 AS stock_level, timestamp'2026-01-01' AS updated_at").write.parquet(path)
    assert changelog.read_source(spark, "inventory", path=path).first()["stock_level"] == 5


def test_snapshot_diff_feeds_the_parser(spark):
    columns = "id int, name string, price double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], columns)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0)], columns)
    changes = diff.snapshot_diff(old, new, ["id"], "things", s.BASE)
    rows = {r["id"]: (r["operation"], r["before_state"], r["after_state"]) for r in changes.collect()}
    assert rows == {
        2: ("update", '{"id":2,"name":"b"}', '{"id":2,"name":"b","price":2.0}'),
        3: ("delete", '{"id":3,"name":"c","price":3.0}', None),
        4: ("insert", None, '{"id":4,"name":"d","price":4.0}'),
    }
    log = envelope.from_change_table(changes.withColumn("change_id", F.col("id").cast("bigint")))
    assert envelope.check_invariants(log).selectExpr("sum(insert_with_before + delete_with_after)").first()[0] == 0


def test_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert tuple(diff.diff_counts(a, b).first()) == (2, 1)
    assert {r["x"]: r["surplus"] for r in diff.diff_runs(a, b).collect()} == {1: 1, 2: 1, 3: -1}


def test_unprocessed_events_are_found_by_identity(spark):
    columns = "change_id long, captured_at string"
    log = spark.createDataFrame([(9, "a"), (10, "b"), (None, "c"), (4, "d"), (None, "e")], columns).selectExpr(
        "'t' AS table", "'insert' AS operation", "map('id', '1') AS before", "map('id', '1') AS after", "captured_at", "change_id"
    )
    marks = changelog.processed_marks(log.filter("captured_at IN ('a', 'e')"))
    assert sorted(r["captured_at"] for r in changelog.read_unprocessed(log, marks).collect()) == ["b", "c", "d"]


def test_instants_in_the_hour_of_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = spark.createDataFrame([("2026-11-01T05:30:00Z",), ("2026-11-01T06:30:00Z",), ("2026-11-01T01:30:00-05:00",)], "t string")
        got = [str(r[0]) for r in text.select(parse_ts(F.col("t")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2026-11-01 05:30:00", "2026-11-01 06:30:00", "2026-11-01 06:30:00"]


def test_raw_delete_codes_are_deletes(spark):
    rows = spark.createDataFrame([(1, "d"), (2, "delete"), (3, "u"), (4, None)], "id int, operation string")
    assert [r["id"] for r in latest.deletes_kept(rows, "drop").orderBy("id").collect()] == [3, 4]
