"""Comparing two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.operators.ordered import null_safe_on

_BUCKET = "_bucket"


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: list[str], table: str, captured_at: str | None = None
) -> DataFrame:
    """The change log that row triggers would have written between two snapshots.

    Inserts carry the after image, deletes the before image, updates both;
    unchanged rows emit nothing. Images are JSON text; ``from_change_table`` reads them.
    ``change_id`` is null: a key changes once in a difference, so no order is lost.
    """
    columns = old.columns
    before = old.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)])
    after = new.select(*columns).select(
        F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)]
    )
    on = null_safe_on(before, after, [(f"_o{i}", f"_n{i}") for i in range(len(keys))])
    paired = before.join(after, on, "full_outer")
    operation = (
        F.when(F.col("_old").isNull(), F.lit("insert"))
        .when(F.col("_new").isNull(), F.lit("delete"))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.lit("update"))
    )
    stamp = F.lit(captured_at) if captured_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    return (
        paired.withColumn("operation", operation)
        .filter(F.col("operation").isNotNull())
        .select(
            F.lit(table).alias("table_name"),
            "operation",
            F.to_json("_old").alias("before_state"),
            F.to_json("_new").alias("after_state"),
            stamp.alias("captured_at"),
            F.lit(None).cast("bigint").alias("change_id"),
            *[F.coalesce(f"_n{i}", f"_o{i}").alias(k) for i, k in enumerate(keys)],
        )
    )


def write_snapshot(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """A snapshot in folders by key bucket, with a digest of every bucket beside it.

    A digest is the count and two 64-bit sums of row hashes, so it doesn't depend on
    the order of rows and repeated rows count. Rows are hashed as they are written.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    df.withColumn(_BUCKET, bucket).hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).mode("overwrite").parquet(f"{path}/rows")
    df.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
    rows = _stored_rows(df.sparkSession, path)
    names = df.columns
    # Nulls leave a hash as it was: their places are hashed with the values.
    hashed = [*[F.col(c) for c in names], *[F.col(c).isNull() for c in names]]
    sums = [F.sum(F.xxhash64(F.lit(seed), *hashed).cast("decimal(38,0)")).alias(f"sum{seed}") for seed in (1, 2)]
    digests = rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("rows"), *sums)
    digests.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")  # one short row per bucket


def _stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored snapshot, also of one without any."""
    fields = spark.read.parquet(f"{path}/columns").schema.fields
    return spark.read.schema(T.StructType([*fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{path}/rows")


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets whose digests differ: at most as many numbers as there are buckets."""
    both = spark.read.parquet(f"{old}/digests").unionByName(spark.read.parquet(f"{new}/digests"))
    # A bucket that is alike on both sides shows up as one group of two.
    alike = both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("sides"))
    return sorted(r[0] for r in alike.filter("sides = 1").select(_BUCKET).distinct().collect())


def stored_snapshot_diff(spark: SparkSession, old: str, new: str, keys: list[str], table: str, captured_at: str | None = None) -> DataFrame:
    """``snapshot_diff`` of two snapshots by ``write_snapshot`` with the same keys and buckets: equal buckets are not read."""
    changed = changed_buckets(spark, old, new)
    left, right = (_stored_rows(spark, p).filter(F.col(_BUCKET).isin(changed)).drop(_BUCKET) for p in (old, new))
    return snapshot_diff(left, right, keys, table, captured_at)


def diff_runs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: ``surplus`` > 0 on the left, < 0 on the right.

    One map-side combined aggregate answers both directions.
    """
    columns = left.columns
    tagged = left.select(*columns, F.lit(1).alias("_s")).union(right.select(*columns, F.lit(-1).alias("_s")))
    return tagged.groupBy(*columns).agg(F.sum("_s").alias("surplus")).filter("surplus <> 0")


def diff_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(only_left, only_right): both 0 for equal results."""
    surplus = F.col("surplus")
    return diff_runs(left, right).agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
    )


def union_findings(*found: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out
