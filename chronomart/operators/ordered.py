"""Ordered look-back and look-ahead inside groups, without a task per hot group.

A window function sends each group to one task. That is right until one group
holds a large part of the table. ``per_group`` counts the groups first (map-side
combined) and takes two ways:

* groups up to ``hot_rows`` rows: the plain window, one exchange, one sort;
* larger groups: rows are range-partitioned on (keys, order), so a group is cut
  into consecutive chunks; the window runs inside the chunks, and what crosses a
  chunk border comes from a small table with one row per (group, chunk).

Both give the same rows. The order has to be total inside a group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.sources.scratch import cut_lineage

HOT_ROWS = 5_000_000
CHUNK_ROWS = 1_000_000
MAX_CHUNKS = 20_000

CHUNK = "_chunk"


def null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


class Groups:
    """Rows with group keys and an order; ``chunk`` names the chunk column, if any."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], chunk: str | None = None):
        self.df, self.keys, self.order, self.chunk = df, keys, order, chunk

    def _with(self, df: DataFrame) -> Groups:
        return Groups(df, self.keys, self.order, self.chunk)

    @property
    def _within(self):
        parts = self.keys + ([self.chunk] if self.chunk else [])
        return Window.partitionBy(*parts).orderBy(*[F.col(c).asc_nulls_last() for c in self.order])

    @property
    def _rank(self) -> Column:
        return F.struct(*[x for c in self.order for x in (F.col(c).isNull(), F.col(c))])

    def _across(self):
        return Window.partitionBy(*self.keys).orderBy(self.chunk)

    def _attach(self, df: DataFrame, edges: DataFrame, carry: str) -> DataFrame:
        """Bring one value per (group, chunk) back to the rows.

        ``edges`` has at most (range partitions + hot groups) rows, both bounded
        in this module, so it is broadcast.
        """
        names = {k: f"_e{i}" for i, k in enumerate(self.keys + [self.chunk])}
        small = edges.select(*[F.col(k).alias(n) for k, n in names.items()], carry)
        on = null_safe_on(df, small, list(names.items()))
        return df.join(F.broadcast(small), on, "left").drop(*names.values())

    def filter(self, condition: Column) -> Groups:
        return self._with(self.df.filter(condition))

    def with_column(self, name: str, value: Column) -> Groups:
        return self._with(self.df.withColumn(name, value))

    def _shifted(self, columns: list[str], name: str, shift, edge_of) -> Groups:
        # Column by column: one struct would cross the exchange next to its own columns.
        flag = shift(F.lit(True)).over(self._within)
        df = self.df.withColumns(
            {name: flag, **{f"{name}_{c}": shift(c).over(self._within) for c in columns}}
        )
        if self.chunk:
            edges = self.df.groupBy(*self.keys, self.chunk).agg(
                edge_of(F.struct(*columns), self._rank).alias("_edge")
            )
            edges = edges.withColumn("_carry", shift("_edge").over(self._across()))
            df = self._attach(df, edges, "_carry")
            inside, carried = F.col(name), F.col("_carry")
            df = df.withColumns(
                {
                    **{
                        f"{name}_{c}": F.when(inside, F.col(f"{name}_{c}")).otherwise(carried[c])
                        for c in columns
                    },
                    name: F.coalesce(inside, F.when(carried.isNotNull(), F.lit(True))),
                }
            ).drop("_carry")
        return self._with(df)

    def previous(self, columns: list[str], name: str) -> Groups:
        """``name_<column>`` of the row before; ``name`` is true where there is one, else NULL."""
        return self._shifted(columns, name, F.lag, F.max_by)

    def following(self, columns: list[str], name: str) -> Groups:
        """``name_<column>`` of the row after; ``name`` is true where there is one, else NULL."""
        return self._shifted(columns, name, F.lead, F.min_by)

    def latest_known(self, column: str, name: str) -> Groups:
        """Last non-NULL value of ``column`` up to and including the row."""
        running = self._within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = self.df.withColumn(name, F.last(column, ignorenulls=True).over(running))
        if self.chunk:
            known = F.when(F.col(column).isNotNull(), self._rank)
            edges = self.df.groupBy(*self.keys, self.chunk).agg(F.max_by(column, known).alias("_edge"))
            before = self._across().rowsBetween(Window.unboundedPreceding, -1)
            edges = edges.withColumn("_carry", F.last("_edge", ignorenulls=True).over(before))
            df = self._attach(df, edges, "_carry")
            df = df.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")
        return self._with(df)

    def number(self, name: str) -> Groups:
        """1-based position in the group."""
        return self._added(F.row_number().over(self._within).cast("bigint"), F.count(F.lit(1)), name)

    def running(self, column: str, name: str) -> Groups:
        """Sum of ``column`` up to and including the row; the order has to be total."""
        rows = self._within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return self._added(F.sum(column).over(rows), F.sum(column), name)

    def _added(self, inside: Column, whole: Column, name: str) -> Groups:
        """What adds up inside a chunk, plus the same of all chunks before."""
        df = self.df.withColumn(name, inside)
        if self.chunk:
            edges = self.df.groupBy(*self.keys, self.chunk).agg(whole.alias("_edge"))
            before = self._across().rowsBetween(Window.unboundedPreceding, -1)
            edges = edges.withColumn("_carry", F.coalesce(F.sum("_edge").over(before), F.lit(0)))
            df = self._attach(df, edges, "_carry")
            df = df.withColumn(name, F.col(name) + F.col("_carry")).drop("_carry")
        return self._with(df)


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int) -> list:
    """Groups above ``hot_rows`` rows: at most ``rows / hot_rows`` of them, whatever the data."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows).collect()


def split_hot(df: DataFrame, keys: list[str], hot: list) -> tuple[DataFrame, DataFrame]:
    """(cold rows, hot rows). The broadcast side is the bounded list of ``hot_groups``."""
    schema = T.StructType([T.StructField(f"_h{i}", df.schema[k].dataType) for i, k in enumerate(keys)])
    table = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
    on = null_safe_on(df, table, [(k, f"_h{i}") for i, k in enumerate(keys)])
    small = F.broadcast(table)
    return df.join(small, on, "left_anti"), df.join(small, on, "left_semi")


def per_group(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    work: Callable[[Groups], Groups],
    hot_rows: int | None = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Apply ``work`` to the ordered groups of ``df``.

    ``hot_rows=None`` skips the count and uses the plain window for every group.
    ``sizes`` has the columns of ``keys`` in their order and names every group at least
    as often as ``df``: where ``df`` is a join or a window, counting it would run that twice.
    The rows never depend on ``sizes``, only the way each group takes.
    """
    counted = df if sizes is None else sizes.toDF(*keys)
    hot = hot_groups(counted, keys, hot_rows) if hot_rows is not None else []
    if not hot:
        return work(Groups(df, keys, order)).df
    cold_df, hot_df = split_hot(df, keys, hot)
    total = sum(r["_rows"] for r in hot)
    chunks = min(max(2, ceil(total / chunk_rows)), MAX_CHUNKS)
    ranged = hot_df.repartitionByRange(
        chunks, *[F.col(k).asc_nulls_last() for k in keys], *[F.col(c).asc_nulls_last() for c in order]
    )
    # The chunk is the range partition a row landed in. Range borders are sampled,
    # so they are stored once and never computed again.
    ranged = cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))
    cold_out = work(Groups(cold_df, keys, order)).df
    hot_out = work(Groups(ranged, keys, order, CHUNK)).df.drop(CHUNK)
    return cold_out.unionByName(hot_out)
