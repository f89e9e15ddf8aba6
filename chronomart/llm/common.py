"""Tables, shared files and connected components for the operators of this package."""

from __future__ import annotations

import string
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.sources.scratch import new_path

#: Fixed value: what separates words in every operator that counts or compares words.
WORD = r"[^\x20\x09-\x0D]+"
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written below the shared folder and read again: survives lost executors, cuts the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under names that no operator uses, and the new name of every column."""
    names = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[df[c].alias(n) for c, n in names.items()]), names


def named_back(names: dict[str, str]) -> list[Column]:
    return [F.col(n).alias(c) for c, n in names.items()]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20):
    """Jobs that run inside send at most so many rows at once to a Python worker, and about so many bytes.

    A batch lies several times in an executor's memory outside its heap, which keeps what large batches once took.
    """
    before = {name: spark.conf.get(name) for name in (BATCH, BATCH_BYTES)}
    spark.conf.set(BATCH, rows)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character untouched; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def fraction(*parts: Column) -> Column:
    """A number in [0, 1) that depends only on ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the graph with edges (a, b); component is its smallest node.

    Alternates large-star and small-star steps, each a pair of grouped minima and
    equi-joins, until the edge set stops changing. Nodes without an edge to another
    node are not returned. The rounds grow with the logarithm of the longest chain.
    """
    pairs = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    pairs = stored(pairs.where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("a").alias("b"), F.col("b").alias("a")).select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), "low").where("a <> low").distinct()
        least = large.groupBy("a").agg(F.min("low").alias("least"))
        small = (
            large.join(least, "a").where("low <> least").select(F.col("low").alias("a"), "least")
            .union(least.select("a", "least")).distinct()
        )
        pairs = stored(small.select(F.col("least").alias("b"), "a"), "edges")
        now = pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
