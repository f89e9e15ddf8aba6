"""Exact duplicates by an extendible-hash index on shared files. DataFrame operations only.

Every distinct text has one index entry under a 64-bit key. The directory maps the
leading bits of a key to a bucket; a bucket that holds more than ``capacity`` entries
is split by one more bit, which doubles the directory, until it fits. The index is
written below the shared folder in bucket order, so that each file owns a range of
keys. Entries of equal key and different bytes are chained.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.common import ascii_lower, named_back, renamed, stored

#: Depth of the directory beyond what evenly spread keys would need.
EXTRA_DEPTH = 3


def entries(docs: DataFrame, key_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: key, sha, keep_id, group_size.

    Copies are combined before the exchange, so a group of any size sends one row per
    map task. Grouping by key and text compares the bytes of all texts of a key.
    """
    text = ascii_lower(F.col(text_col))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("norm"))
    keyed = keyed.select("id", "norm", F.shiftright(F.xxhash64("norm"), 64 - key_bits).alias("key"))
    grouped = keyed.groupBy("key", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return grouped.select("key", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")


def directory(index: DataFrame, capacity: int, key_bits: int = 64) -> tuple[DataFrame, int]:
    """(cell, bucket, depth) for every used cell of the fully doubled directory, and its depth.

    A cell is the value of the leading ``depth`` bits. Its bucket is the first of the
    nested prefixes, from the whole key space down, that holds at most ``capacity``
    entries; the bucket is named by the first cell that it covers.
    """
    n = index.count()
    deepest = min(key_bits, max(1, math.ceil(math.log2(max(n, 1) / capacity + 1)) + EXTRA_DEPTH))
    cells = index.groupBy(cell(deepest, key_bits).alias("cell")).count()
    cells = stored(cells, "directory-cells")
    spread = cells.select("cell", "count", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"))
    prefix = F.expr(f"shiftleft(shiftright(cell, {deepest} - depth), {deepest} - depth)")
    held = spread.groupBy("depth", prefix.alias("prefix")).agg(F.sum("count").alias("held"))
    fits = held.where((F.col("held") <= capacity) | (F.col("depth") == deepest))
    at = spread.select("cell", "depth", prefix.alias("prefix")).join(fits, ["depth", "prefix"])
    first = at.groupBy("cell").agg(F.min(F.struct("depth", "prefix")).alias("at"))
    return first.select("cell", F.col("at.prefix").alias("bucket"), F.col("at.depth").alias("depth")), deepest


def cell(depth: int, key_bits: int = 64):
    """The leading ``depth`` bits of a signed key of ``key_bits`` bits, in key order from zero."""
    return F.shiftright("key", key_bits - depth) + F.lit(1 << (depth - 1))


def build_index(docs: DataFrame, capacity: int = 1 << 20, key_bits: int = 64, **columns: str) -> DataFrame:
    """The index as stored: bucket, depth, key, chain, sha, keep_id, group_size.

    ``chain`` numbers the texts of one key from 1. Files hold ascending, disjoint
    ranges of buckets, each owned by one task.
    """
    found = stored(entries(docs, key_bits, **columns), "index-entries")
    buckets, depth = directory(found, capacity, key_bits)
    placed = found.withColumn("cell", cell(depth, key_bits)).join(buckets, "cell")
    owned = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "sha")
    index = stored(owned.select("bucket", "depth", "key", "sha", "keep_id", "group_size"), "index")
    chain = F.row_number().over(Window.partitionBy("key").orderBy("sha"))
    return index.withColumn("chain", chain)


def exact_dedup(docs: DataFrame, capacity: int = 1 << 20, key_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
    equal texts the row with the largest id stays. Null ids lose to any other; a group
    with null ids only keeps its rows. Rows that repeat id and text are one document
    and are all marked kept. An empty table gives an empty result; other columns are
    not looked at. Inside a chain, whose texts were told apart by their bytes, the
    SHA-256 digest names a text.
    """
    index = build_index(docs, capacity, key_bits, id_col=id_col, text_col=text_col)
    text = ascii_lower(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("norm")).select(
        "doc_id", F.shiftright(F.xxhash64("norm"), 64 - key_bits).alias("key"), F.sha2("norm", 256).alias("sha")
    )
    return keyed.join(index, ["key", "sha"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), "bucket", "chain",
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever their names; of repeated rows one stays.

    Null texts count as empty, so one row of all null and empty texts stays; among rows
    of equal id and text a hash of all columns decides. Texts are compared whole. An
    empty table gives an empty result.
    """
    rows, names = renamed(docs)
    ident, text = names[id_col], names[text_col]
    flags = exact_dedup(rows, id_col=ident, text_col=text, **parameters).where("kept")
    kept = flags.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    marked = rows.withColumn("__text", F.sha2(ascii_lower(F.col(text)), 256))
    stay = marked.join(kept, F.col(ident).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__sha")), "left_semi")
    one = F.row_number().over(Window.partitionBy(ident, "__text").orderBy(F.xxhash64(*names.values())))
    return stay.withColumn("__row", one).where("__row = 1").select(*named_back(names))
