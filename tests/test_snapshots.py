"""Stored snapshots with digests, and sketches that merge."""

from pathlib import Path

from pyspark.sql import functions as F

from chronomart.operators import diff, marts
from chronomart.sources.scratch import new_path

SCHEMA = "k long, name string, n long"


def stored(spark, rows, buckets=16):
    path = new_path(spark, "snapshot")
    diff.write_snapshot(spark.createDataFrame(rows, SCHEMA), path, ["k"], buckets)
    return path


def test_only_buckets_that_differ_are_read(spark):
    rows = [(k, f"n{k}", k % 7) for k in range(500)] + [(None, None, 1)]
    old = stored(spark, rows)
    new = stored(spark, [(k, "other" if k == 41 else name, n) for k, name, n in rows if k != 77][::-1])
    changed = diff.changed_buckets(spark, old, new)
    assert 1 <= len(changed) <= 2
    for path in (old, new):
        for file in Path(path).glob("rows/_bucket=*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in changed:
                file.write_bytes(b"not to be read")
    found = diff.stored_snapshot_diff(spark, old, new, ["k"], "t")
    assert sorted((r.k, r.operation) for r in found.collect()) == [(41, "update"), (77, "delete")]


def test_equal_and_empty_snapshots(spark):
    rows = [(1, None, 2), (1, None, 2), (2, "a", None)]
    one, again, none = stored(spark, rows), stored(spark, rows[::-1]), stored(spark, [])
    assert diff.changed_buckets(spark, one, again) == []
    assert diff.stored_snapshot_diff(spark, one, again, ["k"], "t").count() == 0
    assert diff.stored_snapshot_diff(spark, none, none, ["k"], "t").count() == 0
    assert {r.operation for r in diff.stored_snapshot_diff(spark, none, one, ["k"], "t").collect()} == {"insert"}


def test_a_null_that_moves_changes_the_digest(spark):
    old, new = stored(spark, [(1, "a", None)]), stored(spark, [(1, None, 5)])
    assert len(diff.changed_buckets(spark, old, new)) == 1


def test_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 5000).alias("user"))
    sketches = marts.distinct_sketches(rows, ["day"], "user").cache()
    halves = [marts.distinct_estimates(sketches.filter(c), []).first()[0] for c in ("day < 5", "day >= 5")]
    whole = marts.distinct_estimates(sketches, []).first()[0]
    assert abs(whole - 5000) <= 5000 * 4 * 1.04 / 64
    assert all(abs(h - 2500) <= 2500 * 4 * 1.04 / 64 for h in halves)
    by_day = marts.distinct_estimates(sketches, ["day"]).collect()
    assert len(by_day) == 10 and all(abs(r.estimate - 500) <= 500 * 4 * 1.04 / 64 for r in by_day)
    sketches.unpersist()
