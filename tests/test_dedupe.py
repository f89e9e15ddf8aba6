"""Keyed duplicate suppression: late repetitions and late news against the same log without repetition."""

from pyspark.sql import functions as F

from chronomart.schemas import ENVELOPE
from chronomart.sources import changelog
from chronomart.streaming.dedupe import BLOCK, PROVIDER, dedupe_keyed, start_deduped
from chronomart.streaming.ingest import ONCE


def event(n, day, table="orders", note="x"):
    at = None if day is None else f"2026-{1 + day // 28:02d}-{1 + day % 28:02d}T00:00:00+00:00"
    return (table, "insert", None, {"note": note}, at, n)


def deliver(spark, source, rows):
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(source)


def run(spark, tmp_path, source):
    stream = spark.readStream.schema(ENVELOPE).parquet(source)
    start_deduped(stream, "30 days", str(tmp_path / "bronze"), str(tmp_path / "ckpt"), ONCE).awaitTermination()
    stored = changelog.read_changes(spark, str(tmp_path / "bronze"))
    return sorted((r.table, r.change_id is None, r.change_id or 0, (r.after or {}).get("note")) for r in stored.collect())


def test_late_repetitions_are_found_and_late_news_are_kept(spark, tmp_path):
    source, before = str(tmp_path / "in"), spark.conf.get(PROVIDER)
    deliver(spark, source, [event(1, 0), event(2, 1), event(1, 0), event(None, 1), event(None, 1), event(1, 0, "items"), event(3 * BLOCK, 2)])
    first = run(spark, tmp_path, source)
    assert first == [("items", False, 1, "x"), ("orders", False, 1, "x"), ("orders", False, 2, "x"), ("orders", False, 3 * BLOCK, "x"), ("orders", True, 0, "x"), ("orders", True, 0, "x")]
    # The stream moves on by 200 days: state of the first days is dropped.
    deliver(spark, source, [event(5 * BLOCK + n, 200) for n in range(3)])
    run(spark, tmp_path, source)
    deliver(spark, source, [event(5 * BLOCK + 9, 201)])
    run(spark, tmp_path, source)
    # 160 and more days late: repetitions, among them one of a forgotten block, and news; all unreadable stamps are late.
    deliver(spark, source, [event(1, 0), event(2, 1), event(3 * BLOCK, 2), event(4, 40, note="new"), event(4, 40, note="new"), event(8, None), event(8, None), event(5 * BLOCK, 200)])
    last = run(spark, tmp_path, source)
    assert last == sorted([*first, ("orders", False, 4, "new"), ("orders", False, 8, "x"), *[("orders", False, 5 * BLOCK + n, "x") for n in (0, 1, 2, 9)]])
    assert run(spark, tmp_path, source) == last
    assert spark.conf.get(PROVIDER) == before


def test_state_forgets_old_blocks(spark, tmp_path):
    source = str(tmp_path / "in")
    for day, ids in ((0, range(0, 4 * BLOCK, 100)), (200, range(8 * BLOCK, 9 * BLOCK, 100)), (201, range(9 * BLOCK, 9 * BLOCK + 5))):
        deliver(spark, source, [event(n, day) for n in ids])
        run(spark, tmp_path, source)
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "block").load(str(tmp_path / "ckpt"))
    assert sorted(r[0] for r in state.select(F.col("key.block")).collect()) == [8, 9]


def test_images_pass_unchanged(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("orders", "update", {"a": None, "b": ""}, {}, "2026-01-01T00:00:00+00:00", 1), ("orders", "delete", {"é": '"'}, None, "2026-01-01T00:00:00+00:00", 2)]
    deliver(spark, source, rows)
    run_rows = spark.readStream.schema(ENVELOPE).parquet(source)
    start_deduped(run_rows, "1 day", str(tmp_path / "bronze"), str(tmp_path / "ckpt"), ONCE).awaitTermination()
    got = {r.change_id: (r.before, r.after) for r in changelog.read_changes(spark, str(tmp_path / "bronze")).collect()}
    assert got == {1: ({"a": None, "b": ""}, {}), 2: ({"é": '"'}, None)}
    assert dedupe_keyed(run_rows, "1 day").isStreaming
