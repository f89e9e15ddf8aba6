"""Point-in-time joins and foreign-key joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.payload import surrogate_key
from chronomart.operators.ordered import HOT_ROWS, Groups, null_safe_on, per_group
from chronomart.sources.scratch import cut_lineage


def fk_join_keys(df: DataFrame, keys_of: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe semi or anti join on distinct keys."""
    renamed = keys_of.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)])
    return df.join(renamed, null_safe_on(df, renamed, [(k, f"_r{i}") for i, k in enumerate(keys)]), how)


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    attributes: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    key_attribute: str | None = None,
) -> DataFrame:
    """Each fact with the attributes of the version valid at its time; NULL when none is.

    An equi join with the half-open window as join condition. Catalyst broadcasts
    the dimension when its measured size allows, else sort-merges; AQE splits hot
    fact keys. The ends of a window cross the exchange once, also as attributes.
    ``key_attribute`` as in ``asof_join``.
    """
    named = {dim_key: "_k", valid_from: "_from", valid_to: "_to"}
    named |= {a: f"_a_{a}" for a in attributes if a not in (*named, key_attribute)}
    side = dim.select(*[F.col(c).alias(n) for c, n in named.items()])
    moment = F.col(fact_ts)
    valid = (moment >= F.col("_from")) & ((moment < F.col("_to")) | F.col("_to").isNull())
    joined = fact.join(side, (fact[fact_key] == F.col("_k")) & valid, "left")
    made = {key_attribute: surrogate_key([F.col("_k")], F.col("_from"))}
    found = {a: made[a] if a in made else F.col(named[a]) for a in attributes}
    return joined.select(*[fact[c] for c in fact.columns], *[value.alias(a) for a, value in found.items()])


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    attributes: list[str],
    order: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int | None = HOT_ROWS,
    key_attribute: str | None = None,
    **limits,
) -> DataFrame:
    """Same answer as ``pit_join`` for windows that do not overlap, without comparing pairs.

    Facts and versions are sorted together per key and the last version is carried
    forward: n log n per key instead of facts x versions, and hot keys are cut into
    chunks. ``order`` is a unique column list of the facts. ``sizes`` in ``limits`` names
    the keys of facts and versions, as in ``per_group``. ``key_attribute`` names the
    attribute that is the ``surrogate_key`` of ``dim_key`` and ``valid_from``, if any: the
    digests don't cross the exchange, where the starts suffice to make them again.
    """
    sent = [a for a in attributes if a != key_attribute]
    made = [F.col(valid_from).alias("from")] if key_attribute in attributes else []
    usable = F.col(fact_key).isNotNull() & F.col(fact_ts).isNotNull()
    version = F.struct(
        F.col(valid_to).alias("until"), *made, *[F.col(a).alias(f"_a_{a}") for a in sent]
    )
    types = {f.name: f.dataType for f in dim.schema}
    named = {c: f"_f{i}" for i, c in enumerate(fact.columns)}
    named[fact_key], named[fact_ts] = "_k", "_t"
    versions = dim.filter(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(dim_key).alias("_k"),
        F.col(valid_from).alias("_t"),
        F.lit(0).alias("_kind"),
        F.col(valid_to).alias("_to"),
        version.alias("_version"),
    )
    facts = fact.filter(usable).select(F.lit(1).alias("_kind"), *[F.col(c).alias(n) for c, n in named.items()])
    both = versions.unionByName(facts, allowMissingColumns=True)

    def work(groups: Groups) -> Groups:
        return groups.latest_known("_version", "_found").filter(F.col("_kind") == 1)

    # Of versions with equal start all but the last have an empty window: it comes last.
    sort = list(dict.fromkeys(["_t", "_kind", "_to", *[named[c] for c in order]]))
    found = per_group(both, ["_k"], sort, work, hot_rows, **limits)
    open_at = F.col("_found.until").isNull() | (F.col("_t") < F.col("_found.until"))

    def attribute(name: str) -> Column:
        if name == key_attribute:
            return surrogate_key([F.col("_k").cast(types[dim_key])], F.col("_found.from"))
        return F.col(f"_found._a_{name}")

    matched = found.select(
        *[F.col(n).cast(fact.schema[c].dataType).alias(c) for c, n in named.items()],
        *[F.when(open_at, attribute(a)).alias(a) for a in attributes],
    )
    unmatched = fact.filter(~usable).select(
        *fact.columns, *[F.lit(None).cast(types[a]).alias(a) for a in attributes]
    )
    return matched.unionByName(unmatched)


#: Cells of one level that make a cell of the next.
FAN = 4
#: The level of facts that no window holds.
NOWHERE = -1
#: A fact is compared with all windows of its key where these are at most so many.
NARROW = 256


def _cells(first: Column, last: Column, height: Column) -> Column:
    """The largest aligned blocks of 1, 4, 16, ... places that together are ``first`` to ``last``, each place in one.

    A level's blocks inside the range lie from ``low`` to ``high``; those under a block of
    the next level that is inside as well are left to it.
    """

    def places(a: Column, b: Column) -> Column:
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))

    def level(n: Column) -> Column:
        def inside(at: Column) -> tuple[Column, Column]:
            size = F.pow(F.lit(float(FAN)), at).cast("bigint")
            return F.call_function("div", first + size - 1, size), F.call_function("div", last + 1, size) - 1

        (low, high), (up_low, up_high) = inside(n), inside(n + 1)
        above = (up_low <= up_high) & (n < height)
        left = places(low, F.when(above, up_low * FAN - 1).otherwise(high))
        right = F.when(above, places((up_high + 1) * FAN, high)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.concat(left, right), lambda c: F.struct(n.alias("_level"), c.alias("_cell")))

    return F.flatten(F.transform(F.sequence(F.lit(0), height), level))


def overlap_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    attributes: list[str],
    order: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int | None = HOT_ROWS,
    sizes: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """Same answer as ``pit_join`` for windows that overlap, at the cost of the matches and not of facts x windows.

    Keys with at most ``NARROW`` windows and ``hot_rows`` facts and windows are left to
    ``pit_join``: a bounded number of comparisons a fact, and each side crosses one exchange.
    The others take the way of ``_overlap_blocks``. The rows are the same either way.
    ``order`` is a unique column list of the facts. ``sizes`` names the keys of facts and
    windows, as in ``per_group``.
    """
    windows = (dim_key, attributes)

    def narrow(facts: DataFrame, dims: DataFrame) -> DataFrame:
        return pit_join(facts, dims, fact_key, fact_ts, *windows, valid_from, valid_to)

    def wide(facts: DataFrame, dims: DataFrame) -> DataFrame:
        return _overlap_blocks(facts, dims, fact_key, fact_ts, *windows, order, valid_from, valid_to, hot_rows, sizes, **limits)

    return _by_width(fact, dim, fact_key, dim_key, hot_rows, sizes, dim.select(dim_key), narrow, wide)


def _by_width(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot_rows: int | None, sizes: DataFrame | None, widths: DataFrame,
    narrow: Callable[[DataFrame, DataFrame], DataFrame], wide: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """``narrow`` for keys with at most ``NARROW`` windows and ``hot_rows`` facts and windows, ``wide`` for the others.

    ``widths`` names the keys of the windows, at least as often as ``dim``.
    """
    held = widths.toDF("_wide").groupBy("_wide").agg(F.count(F.lit(1)).alias("_rows"))
    found = held.filter((F.col("_rows") > NARROW) & F.col("_wide").isNotNull()).select("_wide")
    if hot_rows is not None:
        known = fact.select(fact_key).union(dim.select(dim_key)) if sizes is None else sizes
        counts = known.toDF("_wide").groupBy("_wide").agg(F.count(F.lit(1)).alias("_rows"))
        found = found.union(counts.filter((F.col("_rows") > hot_rows) & F.col("_wide").isNotNull()).select("_wide"))
    found = cut_lineage(found.distinct())
    if found.isEmpty():
        return narrow(fact, dim)

    def of(df: DataFrame, key: str, how: str) -> DataFrame:
        return df.join(found, df[key] == found["_wide"], how)

    cold = narrow(of(fact, fact_key, "left_anti"), of(dim, dim_key, "left_anti"))
    return cold.unionByName(wide(of(fact, fact_key, "left_semi"), of(dim, dim_key, "left_semi")))


def _overlap_blocks(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    attributes: list[str],
    order: list[str],
    valid_from: str,
    valid_to: str,
    hot_rows: int | None,
    sizes: DataFrame | None,
    **limits,
) -> DataFrame:
    """Facts and windows meet in blocks of time, so that the join makes matches and nothing else.

    The ends of a key's windows cut time into places, numbered in order. A fact looks its
    place up as of its time; a window is a range of places, split into few aligned
    blocks. Fact and window meet in an equi join on the one block of the window that
    holds the fact's place, so the join makes no row that is not a match. A fact is sent
    once per block size that its key's windows use, at most the logarithm of their
    number. Whether a fact has no match at all is known from its place: how many windows
    are open there: such a fact passes the same join, in a cell of its own that no window
    has. Hot keys spread over their blocks.
    """
    start, end = F.col("_from"), F.col("_to")
    windows = dim.select(
        F.col(dim_key).alias("_k"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"),
        *[F.col(a).alias(f"_a_{a}") for a in attributes],
    ).filter(F.col("_k").isNotNull() & start.isNotNull() & (end.isNull() | (end > start)))
    steps = F.array(F.struct(start.alias("_at"), F.lit(1).alias("_step")), F.struct(end.alias("_at"), F.lit(-1).alias("_step")))
    ends = windows.select("_k", F.inline(steps)).filter(F.col("_at").isNotNull()).groupBy("_k", "_at").agg(F.sum("_step").alias("_step"))

    def work(groups: Groups) -> Groups:
        return groups.number("_n").running("_step", "_open").with_column("_place", F.col("_n") - 1)

    # A window has at most two ends.
    named_twice = windows.select("_k").union(windows.select("_k"))
    places = per_group(ends, ["_k"], ["_at"], work, hot_rows, sizes=named_twice, **limits)
    places = cut_lineage(places.select("_k", "_at", "_place", "_open"))
    # Half the bits of the last place, rounded up: so many levels of blocks hold all places.
    bits = F.length(F.bin(F.max("_place")))
    heights = places.groupBy("_k").agg(F.call_function("div", bits + 1, F.lit(2)).cast("int").alias("_height"))
    first = places.select("_k", F.col("_at").alias("_from"), F.col("_place").alias("_first"))
    after = places.select("_k", F.col("_at").alias("_to"), F.col("_place").alias("_after"))
    ranged = windows.join(first, ["_k", "_from"]).join(after, ["_k", "_to"], "left").join(heights, "_k")
    # An open window ends with the largest block.
    last = F.coalesce(F.col("_after"), F.pow(F.lit(float(FAN)), F.col("_height")).cast("bigint")) - 1
    blocks = ranged.select("_k", F.inline(_cells(F.col("_first"), last, F.col("_height"))), *[f"_a_{a}" for a in attributes])
    blocks = cut_lineage(blocks)
    levels = blocks.groupBy("_k").agg(F.collect_set("_level").alias("_levels"))
    looked = places.join(levels, "_k").withColumn("_end", F.lit(None).cast(dict(dim.dtypes)[valid_to]))
    # Facts travel under names that no caller's column clashes with.
    named = {c: f"_f{i}" for i, c in enumerate(fact.columns)}
    facts = fact.select(*[F.col(c).alias(n) for c, n in named.items()])
    key = named[fact_key]
    known = facts.select(key).union(windows.select("_k")) if sizes is None else sizes
    placed = asof_join(
        facts, looked, key, named[fact_ts], "_k", ["_place", "_open", "_levels"], [named[c] for c in order], "_at", "_end", hot_rows,
        sizes=known.union(windows.select("_k")), **limits,
    )
    hit = F.coalesce(F.col("_open") > 0, F.lit(False))
    levels_of = F.when(hit, F.col("_levels")).otherwise(F.array(F.lit(NOWHERE)))
    sent = placed.select(*named.values(), "_place", F.explode(levels_of).alias("_level"))
    in_level = F.call_function("div", "_place", F.pow(F.lit(float(FAN)), F.col("_level")).cast("bigint"))
    # Facts that meet nothing are many under one key, or under none: each has its own cell.
    alone = F.xxhash64(*[named[c] for c in order])
    sent = sent.withColumn("_cell", F.when(F.col("_level") == NOWHERE, alone).otherwise(in_level))
    met = sent.join(blocks.withColumnRenamed("_k", key).withColumn("_met", F.lit(True)), [key, "_level", "_cell"], "left")
    return met.filter((F.col("_level") == NOWHERE) | F.col("_met")).select(
        *[F.col(n).alias(c) for c, n in named.items()], *[F.col(f"_a_{a}").alias(a) for a in attributes]
    )


def point_in_time(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    attributes: list[str],
    order: list[str],
    method: str = "auto",
    disjoint: bool = True,
    key_attribute: str | None = None,
    widths: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """``asof_join`` where the caller declares the windows of a key disjoint, as ``scd2`` makes them, else ``overlap_join``.

    The choice never depends on the data, so equal inputs give equal rows at any size.
    With ``widths``, which names the keys of ``dim`` at least as often as it does, the as-of
    form is kept for keys with many windows or rows, and the others are left to ``pit_join``.
    """
    if method == "auto":
        method = "asof" if disjoint else "overlap"
    keys = (fact_key, fact_ts, dim_key, attributes)

    def interval(facts: DataFrame, dims: DataFrame) -> DataFrame:
        return pit_join(facts, dims, *keys, key_attribute=key_attribute)

    def asof(facts: DataFrame, dims: DataFrame) -> DataFrame:
        return asof_join(facts, dims, *keys, order, key_attribute=key_attribute, **limits)

    if method == "interval":
        return interval(fact, dim)
    if method == "asof" and widths is not None:
        return _by_width(fact, dim, fact_key, dim_key, limits.get("hot_rows", HOT_ROWS), limits.get("sizes"), widths, interval, asof)
    if method == "asof":
        return asof(fact, dim)
    if method == "overlap":
        return overlap_join(fact, dim, fact_key, fact_ts, dim_key, attributes, order, **limits)
    raise ValueError(f"method must be auto, interval, asof or overlap, not {method!r}")


def resolve(fact: DataFrame, dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Dimension attributes by surrogate key; facts without a key drop out."""
    return fact.join(dim.select(key, *attributes), key, "inner").select(*fact.columns, *attributes)


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent. A NULL key needs a NULL parent; no parents at all, no check."""
    if parent.isEmpty():
        return child.filter(F.lit(False))
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    return child.join(known, child[child_key].eqNullSafe(known["_p"]), "left_anti")


def fk_violation_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """(evaluated, violations) without a join: both sides are combined per key before the one exchange."""
    kind = child.schema[child_key].dataType
    sides = child.select(F.col(child_key).alias("_k"), F.lit(1).alias("_c"), F.lit(0).alias("_p")).unionByName(
        parent.select(F.col(parent_key).cast(kind).alias("_k"), F.lit(0).alias("_c"), F.lit(1).alias("_p"))
    )
    per_key = sides.groupBy("_k").agg(F.sum("_c").alias("_c"), F.max("_p").alias("_p"))
    orphans: Column = F.sum(F.when(F.col("_p") == 0, F.col("_c")).otherwise(0))
    return per_key.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("evaluated"),
        F.when(F.max("_p") == 1, orphans).otherwise(0).alias("violations"),
    )
