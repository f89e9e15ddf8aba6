"""A Merkle manifest of a table, and a climb that checks every row against its root.

Rows are leaves of their group's tree, in id order; 16 consecutive nodes become one
node until one is left, and the groups' roots likewise become the root of all. Levels
are built by one aggregation each. Every inner node is stored as a row with its
children's digests and a link to its parent. A recursive query starts at the claimed
digests of the leaves and follows the links, appending siblings and folding the claims
into new digests. The leaves of a run share all siblings above it, so a run climbs as one
row with up to 16 claims.

The place of a leaf in its group comes from range partitions and their counts, so a
group that holds a third of all rows, or all of them, is never in one task. Levels, nodes
and the climb are Parquet tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import stored
from chronomart.sources.scratch import new_path

ARITY = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Bytes of a digest; tables hold digests as bytes, hashes take them as lowercase hex.
DIGEST = 32
#: The tree of the groups' roots. Groups have other names: null "0", others "1" and their name.
TOP = ""
#: The levels are 1 for the parents of leaves, 2 for theirs, and so on.
KEY = ["tree", "level", "idx"]


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def framed(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value: no two rows give the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return hashed(F.concat(*[framed(v) for v in values]))


@dataclass
class Manifest:
    """``leaves``: id, tree, idx, n (of the tree), leaf, claim. ``nodes``: the key, up (the parent's key and the place in it), n, children, hash."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame


def ranked(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` stored, with idx (from 0) and n of each row in its group, without a task that sees a whole group."""
    rows = stored(df.repartitionByRange(*by, *order).withColumn("pid", F.spark_partition_id()), name)
    # One row per group and range partition that holds some of it.
    counts = rows.groupBy(*by, "pid").agg(F.count("*").alias("here"))
    group = Window.partitionBy(*by)
    before = F.sum("here").over(group.orderBy("pid")) - F.col("here")
    counts = counts.select(*by, "pid", before.alias("before"), F.sum("here").over(group).alias("n"))
    inside = F.row_number().over(Window.partitionBy(*by, "pid").orderBy(*order)) - 1
    return rows.withColumn("inside", inside).join(counts, [*by, "pid"]).select(*df.columns, (F.col("before") + F.col("inside")).alias("idx"), "n")


def _run(rows: DataFrame, arity: int) -> DataFrame:
    """The parents of consecutive nodes (tree, idx, hash, n)."""
    children = F.array_sort(F.collect_list(F.struct("idx", "hash")))
    parents = rows.where("n > 1").groupBy("tree", F.expr(f"idx div {arity}").alias("idx")).agg(
        F.ceil(F.first("n") / arity).alias("n"), children.alias("children")
    )
    joined = F.aggregate("children", F.lit(b""), lambda all_digests, one: F.concat(all_digests, one["hash"]))
    return parents.withColumn("children", joined).withColumn("hash", hashed(hex_of(F.col("children"))))


def _levels(first: DataFrame, arity: int, name: str) -> DataFrame:
    """All inner nodes above ``first`` (tree, idx, hash, n), each level stored from the one below."""
    spark = first.sparkSession
    folder = new_path(spark, name)
    schema = _run(first, arity).schema
    level, below = 1, first
    most = first.agg(F.max("n")).first()[0] or 0
    _run(first, arity).limit(0).write.parquet(f"{folder}/level=0")
    while most > 1:
        path = f"{folder}/level={level}"
        _run(below, arity).write.parquet(path)
        below, level, most = spark.read.schema(schema).parquet(path), level + 1, -(-most // arity)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("level", T.IntegerType())])).parquet(folder)


def _up(level: Column, arity: int) -> Column:
    return F.when(F.col("n") > 1, F.struct(
        F.col("tree").alias("tree"), (level + 1).cast("int").alias("level"), F.expr(f"idx div {arity}").alias("idx"),
        (F.col("idx") % arity).cast("int").alias("slot"),
    ))


def build(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: list[str] = FIELDS, arity: int = ARITY,
    tampered: Callable[[dict[str, Column]], Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``. ``claim`` is the leaf digest that ``tampered`` gives for a row, the true one without it."""
    columns = {c: F.col(c) for c in fields}
    true = leaf_hash(list(columns.values()))
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),
        true.alias("leaf"), (F.lit(None).cast("binary") if tampered is None else tampered(columns)).alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = leaves.withColumn("claim", F.coalesce("claim", "leaf"))
    # The digest settles equal ids, the row number only cuts repeated rows into several tasks.
    leaves = stored(ranked(stored(leaves, "leaves"), ["tree"], ["id", "leaf", "row"], "ordered"), "places")
    nodes = _levels(leaves.select("tree", "idx", F.col("leaf").alias("hash"), "n"), arity, "levels")
    roots = nodes.where("n = 1").select("tree", "hash").unionByName(leaves.where("n = 1").select("tree", F.col("leaf").alias("hash")))
    roots = ranked(roots.withColumn("all", F.lit(0)), ["all"], ["tree"], "roots").select("tree", "hash", "idx", "n")
    roots = stored(roots, "roots")
    at_top = roots.select(F.lit(TOP).alias("tree"), "idx", "hash", "n")
    over = _levels(at_top, arity, "top")
    # A tree's root hangs below the top tree; what is above a single root is nothing.
    tops = stored(roots.select(F.col("tree").alias("of"), _up_from_root(arity).alias("up")), "tops")
    inner = nodes.where("n > 1").withColumn("up", _up(F.col("level"), arity))
    last = nodes.where("n = 1").join(tops, F.col("tree") == F.col("of")).drop("of")
    over = over.withColumn("up", _up(F.col("level"), arity))
    every = inner.unionByName(last).unionByName(over)
    return Manifest(leaves, stored(every, "nodes"), tops)


def _up_from_root(arity: int) -> Column:
    return F.when(F.col("n") > 1, F.struct(
        F.lit(TOP).alias("tree"), F.lit(1).alias("level"), F.expr(f"idx div {arity}").alias("idx"), (F.col("idx") % arity).cast("int").alias("slot"),
    ))


def _others(children: Column, slot: Column) -> Column:
    """The digests before and after a place."""
    cut = slot * DIGEST
    return F.struct(
        children.substr(F.lit(1), cut).alias("before"),
        children.substr(cut + DIGEST + 1, F.octet_length(children)).alias("after"),
    )


#: What the climb does at each node: fold the claims into the node's digest, append the siblings.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT bundle, up, folded, above, hash, subroot FROM {{base}}
  UNION ALL
  SELECT c.bundle, r.up,
    transform(c.folded, f -> unhex(sha2(lower(hex(concat(
      substring(r.children, 1, {DIGEST} * c.up.slot), f, substring(r.children, {DIGEST} * c.up.slot + {DIGEST + 1})))), 256))),
    concat(c.above, substring(r.children, 1, {DIGEST} * c.up.slot), substring(r.children, {DIGEST} * c.up.slot + {DIGEST + 1})),
    r.hash, coalesce(c.subroot, CASE WHEN r.n = 1 THEN r.hash END)
  FROM climb c JOIN {{nodes}} r ON r.tree = c.up.tree AND r.level = c.up.level AND r.idx = c.up.idx
)
SELECT bundle, folded, above, hash, subroot FROM climb WHERE up IS NULL
"""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climb(manifest: Manifest, arity: int = ARITY) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof (digest of the siblings on the way), folded_root, verified; digests as hex.

    The recursion has as many steps as a tree has levels, a logarithm of its leaves.
    """
    spark = manifest.nodes.sparkSession
    leaves = manifest.leaves
    members = F.array_sort(F.collect_list(F.struct((F.col("idx") % arity).cast("int").alias("slot"), "id", "leaf", "claim")))
    runs = leaves.where("n > 1").groupBy(F.col("tree").alias("of"), F.expr(f"idx div {arity}").alias("run")).agg(members.alias("members"))
    bottom = manifest.nodes.where((F.col("level") == 1) & (F.col("tree") != TOP))
    runs = runs.join(bottom, (F.col("of") == F.col("tree")) & (F.col("run") == F.col("idx")))
    fold = lambda m: hashed(hex_of(F.concat(
        _others(F.col("children"), m["slot"])["before"], m["claim"], _others(F.col("children"), m["slot"])["after"])))
    runs = runs.select("up", "members", "children", F.transform("members", fold).alias("folded"), "hash", F.when(F.col("n") == 1, F.col("hash")).alias("subroot"))
    alone = leaves.where("n = 1").join(manifest.tops, F.col("tree") == F.col("of")).select(
        "up", F.array(F.struct(F.lit(0).alias("slot"), "id", "leaf", "claim")).alias("members"), F.lit(b"").alias("children"),
        F.array("claim").alias("folded"), F.col("leaf").alias("hash"), F.col("leaf").alias("subroot"),
    )
    base = runs.unionByName(alone).withColumns({"bundle": F.monotonically_increasing_id(), "above": F.lit(b"")})
    base = stored(base, "bundles")
    # The limit is on rows in all, and rows grow with the input; the depth has its own.
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        ended = stored(spark.sql(CLIMB, base=base, nodes=manifest.nodes), "climb")
    finally:
        spark.conf.set(ROW_LIMIT, before)
    rows = base.select("bundle", "members", "children").join(ended, "bundle")
    one = rows.select("children", "above", "hash", "subroot", F.explode(F.arrays_zip("members", "folded")).alias("m"))
    one = one.withColumn("beside", _others(F.col("children"), F.col("m.members.slot")))
    proof = hex_of(F.concat("beside.before", "beside.after", "above"))
    return one.select(
        F.col("m.members.id").alias("id"), hex_of(F.col("m.members.leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"),
        hex_of(F.col("hash")).alias("root"), F.sha2(proof, 256).alias("proof"), hex_of(F.col("m.folded")).alias("folded_root"),
        (F.col("m.folded") == F.col("hash")).alias("verified"),
    )


def verified(
    docs: DataFrame, tampered: Callable[[dict[str, Column]], Column] | None = None, id_col: str = "doc_id", group_col: str = "source",
    fields: list[str] = FIELDS, arity: int = ARITY,
) -> DataFrame:
    """Builds the manifest of ``docs`` and climbs it from the claimed leaves.

    Nulls are marked as such in a leaf, so they differ from empty texts; null groups
    form the first tree, null ids are first in theirs; equal ids are ordered by digest;
    repeated rows are leaves of their own; texts are hashed whole; an empty table has no
    rows and no root; columns that aren't asked for are not read, whatever their names.
    """
    return climb(build(docs, id_col, group_col, fields, arity, tampered), arity)
