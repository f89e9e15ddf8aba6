"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame operations only.

Documents are dealt by hash to blocks of one source. Each source has an exact quota of
block draws: whole passes over its blocks, then blocks in hashed order until the
target is met, the last one in part. The quotas are split among the output shards
down a binary tree: at each node the left half receives a multivariate-hypergeometric
draw of the node's quotas, one univariate draw per source, conditional on those
before. That is the law of dealing out all block draws in random order, without any
global sort. Shards then take disjoint runs of each source's permuted block draws and
are shuffled on their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.common import WORD, fraction, named_back, renamed, stored

#: Fixed value: weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times the size of its source.
CAP = 3
#: Levels of the tree between two stored tables.
LEVELS_AT_ONCE = 6
ID = "__mix"


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, idx, source_size, target) from (source, source_size).

    Sources in code-point order, null last, share all words by weight. A share above
    ``cap`` times its source is cut and the excess goes to the others by weight until
    none is above: with the sources in ascending cap per weight, those cut are the
    shortest prefix after which one common rate leaves every other share below its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("idx", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("w", F.element_at(cycle, (F.col("idx") % len(weights) + 1).cast("int")))
    by_cap = Window.orderBy(F.col("source_size") / F.col("w"), "idx")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    rated = ranked.withColumn("rate", rate).withColumn("free", F.col("rate") * F.col("w") <= cap * F.col("source_size"))
    chosen = rated.withColumn("first", F.min(F.when(F.col("free"), F.struct(F.col("source_size") / F.col("w"), "idx", "rate"))).over(every))
    target = F.least(F.col("first.rate") * F.col("w"), (cap * F.col("source_size")).cast("double"))
    return chosen.select("source", F.col("idx").cast("int").alias("idx"), "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def hypergeometric(n: str, k: str, draws: str, u: str) -> str:
    """SQL for a hypergeometric draw: marked ones among ``draws`` of ``n``, ``k`` of them marked.

    Inverts the distribution function at ``u`` by the ratio of neighbouring terms,
    over ten standard deviations around the mean; what lies beyond is below the
    resolution of a double.
    """
    mean = f"({draws} * cast({k} as double) / {n})"
    sd = f"sqrt({mean} * (1 - {k} / {n}) * ({n} - {draws}) / greatest({n} - 1, 1))"
    low = f"greatest(0, {draws} + {k} - {n}, cast(floor({mean} - 10 * {sd}) as bigint) - 10)"
    high = f"least({draws}, {k}, cast(ceil({mean} + 10 * {sd}) as bigint) + 10)"
    step = f"({k} - i + 1) * cast({draws} - i + 1 as double) / (i * cast({n} - {k} - {draws} + i as double))"
    over = "if(r.lo >= r.hi, cast(array() as array<bigint>), sequence(r.lo + 1, r.hi))"
    total = f"""aggregate({over}, named_struct('w', 1D, 't', 1D),
        (s, i) -> named_struct('w', s.w * {step}, 't', s.t + s.w * {step}), s -> s.t)"""
    find = f"""aggregate({over}, named_struct('x', r.lo, 'w', 1D, 't', 1D), (s, i) -> if(s.t > goal, s,
        named_struct('x', i, 'w', s.w * {step}, 't', s.t + s.w * {step})), s -> s.x)"""
    ranged = f"named_struct('lo', cast({low} as bigint), 'hi', cast({high} as bigint))"
    inner = f"transform(array({u} * {total}), goal -> {find})[0]"
    return f"if({n} = 0, 0L, transform(array({ranged}), r -> {inner})[0])"


def split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, idx, quota): the block draws of every source that each shard receives.

    ``quotas`` has one row, the array ``quotas`` by source index. Shard sizes differ by
    one at most. A node is one row with one array over the sources.
    """
    levels = round(math.log2(shards))
    nodes = quotas.select(F.lit(0).cast("long").alias("node"), "quotas")
    total = "aggregate(quotas, 0L, (a, q) -> a + q)"
    nodes = nodes.select("node", "quotas", F.expr(total).alias("all"))
    for level in range(levels):
        span = shards >> level
        first, middle = f"node * {span}", f"node * {span} + {span // 2}"
        left = f"cast(floor(({middle}) * cast(all as decimal(20)) / {shards}) as bigint) - cast(floor(({first}) * cast(all as decimal(20)) / {shards}) as bigint)"
        u = f"shiftrightunsigned(xxhash64({seed}, {level}, node, size(acc.out)), 11) * {2.0**-53!r}D"
        draw = hypergeometric("acc.n", "q", "acc.d", u)
        folded = f"""aggregate(quotas,
            named_struct('n', {total}, 'd', {left}, 'out', cast(array() as array<bigint>)),
            (acc, q) -> transform(array({draw}), x -> named_struct(
                'n', acc.n - q, 'd', acc.d - x, 'out', concat(acc.out, array(x))))[0],
            acc -> acc.out)"""
        nodes = nodes.select("node", "all", "quotas", F.expr(folded).alias("left")).select(
            "all",
            F.expr("""inline(array(
                named_struct('node', node * 2, 'quotas', left),
                named_struct('node', node * 2 + 1, 'quotas', zip_with(quotas, left, (q, x) -> q - x))))"""),
        )
        if level % LEVELS_AT_ONCE == LEVELS_AT_ONCE - 1 and level < levels - 1:
            nodes = stored(nodes.repartition("node"), "mix-tree")
    return nodes.select(F.col("node").alias("shard"), F.posexplode("quotas").alias("idx", "quota"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **parameters) -> DataFrame:
    """The rows and columns of ``docs`` with a struct column ``__mix`` that says what the mix takes.

    ``__mix`` holds size, source_size, target, taken and draws, an array of (shard, pass,
    words). Every row is drawn at most ``cap`` + 1 times and never above ``cap`` times
    its size; of one document per source a part may be counted, for exact quotas. Null
    text has size 0 and is never drawn; null is a source of its own. Equal rows are
    drawn one by one. The result depends on ids and ``seed`` alone, so reruns agree. An
    empty table gives an empty result. Texts are counted whole, however long. Columns of
    any name are kept, but for one named ``__mix``, which is replaced.
    """
    rows, names = renamed(docs)
    mixed = _mix(rows, names[id_col], names[text_col], names[source_col], **parameters)
    return mixed.select(*named_back({c: n for c, n in names.items() if c != ID}), ID)


def _mix(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int = 7, weights=WEIGHTS, cap: int = CAP,
    block_words: int = 1 << 18, shard_draws: int = 64,
) -> DataFrame:
    ident = F.xxhash64(F.lit(seed), F.col(id_col))
    rows = docs.withColumn(ID, F.struct(F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), ident.alias("at")))
    slim = stored(rows.select(f"{ID}.*"), "mix-sizes")
    plan = stored(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "mix-targets")
    quota = F.round("target").cast("long")
    plan = plan.withColumn("passes", F.coalesce(F.expr("cast(round(target) as bigint) div nullif(source_size, 0)"), F.lit(0)).cast("int"))
    plan = plan.withColumn("rest", quota - F.col("passes") * F.col("source_size"))
    plan = plan.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    plan = stored(plan.withColumnRenamed("source", "of"), "mix-plan")
    block = F.pmod(F.col("at"), F.col("n_blocks"))

    blocks = slim.join(plan, F.col("source").eqNullSafe(F.col("of"))).groupBy("idx", block.alias("block")).agg(
        F.sum("size").alias("words"), F.first("passes").alias("passes"), F.first("rest").alias("rest")
    )
    sofar = Window.partitionBy("idx").orderBy(F.xxhash64(F.lit(seed), "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - F.coalesce(F.sum("words").over(sofar), F.lit(0))))
    blocks = blocks.withColumn("last", last).where("words > 0")
    passes = F.filter(F.sequence(F.lit(0), F.col("passes")), lambda p: (p < F.col("passes")) | (F.col("last") > 0))
    units = blocks.select("idx", "block", F.explode(passes).alias("pass"), F.when(F.col("pass") == F.col("passes"), F.col("last")).alias("limit"))
    turn = Window.partitionBy("idx").orderBy(F.xxhash64(F.lit(seed), "block", "pass"), "block", "pass")
    units = stored(units.withColumn("turn", F.row_number().over(turn).cast("long")), "mix-units")

    count = plan.select("idx").join(units.groupBy("idx").agg(F.count("*").alias("quota")), "idx", "left")
    quotas = count.agg(F.expr("transform(array_sort(collect_list(struct(idx, coalesce(quota, 0L) as quota))), x -> x.quota)").alias("quotas"))
    shards = 1 << max(0, math.ceil(math.log2(max(1, units.count()) / shard_draws)))
    leaves = stored(split(stored(quotas, "mix-quotas"), shards, seed), "mix-leaves")
    end = F.sum("quota").over(Window.partitionBy("idx").orderBy("shard"))
    slots = leaves.withColumn("end", end).where("quota > 0").select(
        "idx", "shard", F.explode(F.sequence(F.col("end") - F.col("quota") + 1, F.col("end"))).alias("turn")
    )
    drawn = units.join(slots, ["idx", "turn"]).groupBy("idx", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard", "limit"))).alias("units")
    )

    placed = rows.join(plan, F.col(f"{ID}.source").eqNullSafe(F.col("of"))).withColumn("__block", F.pmod(F.col(f"{ID}.at"), F.col("n_blocks")))
    drawn = drawn.select(F.col("idx").alias("__of"), F.col("block").alias("__in"), F.col("units").alias("__units"))
    inside = Window.partitionBy("__idx", "__block").orderBy(f"{ID}.at", f"{ID}.size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        *[docs[c] for c in docs.columns], ID, F.col("idx").alias("__idx"), "__block",
        F.struct("source_size", "target").alias("__plan"),
    )
    placed = placed.withColumn("__before", F.coalesce(F.sum(f"{ID}.size").over(inside), F.lit(0)))
    joined = placed.join(drawn, (F.col("__idx") == F.col("__of")) & (F.col("__block") == F.col("__in")), "left")
    draws = F.expr(f"""filter(transform(coalesce(__units, array()), u -> named_struct('shard', u.shard, 'pass', u.pass, 'words',
        if(u.limit is null, {ID}.size, greatest(0L, least({ID}.size, u.limit - __before))))), d -> d.words > 0)""")
    joined = joined.withColumn("__draws", draws)
    out = F.struct(
        f"{ID}.size", "__plan.source_size", "__plan.target",
        F.expr("aggregate(__draws, 0L, (a, d) -> a + d.words)").alias("taken"), F.col("__draws").alias("draws"),
    )
    return joined.select(*docs.columns, out.alias(ID))


def mixture(
    docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **parameters
) -> DataFrame:
    """The mixed rows with the columns of ``docs``: one row per draw, in shards, each in its own random order.

    Every row carries its unchanged text: the document that an exact quota would take in
    part, one per source at most, is taken whole. So a source gets its target and less than
    one document more, and none with a target is left out. Partitions hold whole shards, so
    written files are the shards in training order. Nulls, ties, repeated rows, empty
    tables and texts of any length are as in ``mix``; columns of any name are kept.
    """
    rows, names = renamed(docs)
    mixed = _mix(rows, names[id_col], names[text_col], names[source_col], seed, **parameters)
    taken = mixed.select("*", F.explode(f"{ID}.draws").alias("__draw"))
    order = fraction(F.lit(seed), F.col("__draw.shard"), F.col("__draw.pass"), F.col(names[id_col]))
    dealt = taken.withColumn("__order", order).repartitionByRange("__draw.shard").sortWithinPartitions("__draw.shard", "__order")
    return dealt.select(*named_back(names))
