"""Exact Jaccard self-join of documents on word shingles by a grouped prefix join.

A set's prefix is its rarest shingles, so many that two sets of the required
similarity must share one. Sets of equal prefix and size form a group. Groups that
share prefix shingles are compared by size and by the number of shared prefix
shingles; the groups that remain are expanded and their members verified.

Nothing pairs all documents of a list. In rounds, each member is verified against
one leader of a list, the one that it shares most with, and links merge components. A
list is led by the set with fewest rare shingles, the least edited of near copies. Then
only members that are still in different components are paired: the shorter prefix that
suffices for the smaller set against the full prefix of the larger one, and only if their
signatures, 512 bits of parity, leave room for the similarity. A pair inside one component would not change the result, so no link
between components is lost. Rounds save work only; they stop when they find nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import components, small_batches, stored
from chronomart.llm.shingles import mixed, shingle_set, word_hashes

#: Counters of the shingle-frequency sketch, which orders shingles by rarity. Its size is fixed:
#: collisions only make the order, and so the candidates, worse, never the result.
SKETCH_BITS = 20
SEGMENT = 1 << 14
#: Segments that a worker sends at once, 1 MB.
SENT = 8
#: Documents whose sets a worker holds at once.
STEP = 1000
#: Bits of the map that tells apart documents to be verified; beyond that many more are read than needed.
BITMAP_BITS = 24
ROUNDS = 3
#: A set's signature: 64 bits each, a bit tells whether an odd number of shingles falls on it.
SIGNATURE = [f"s{i}" for i in range(8)]

MARKS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("c1", T.LongType()),
    T.StructField("c2", T.LongType()), T.StructField("segment", T.IntegerType()), T.StructField("counts", T.BinaryType()),
])
PREFIXES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("c1", T.LongType()),
    T.StructField("c2", T.LongType()), T.StructField("gid", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.LongType()) for c in SIGNATURE],
])
SETS = T.StructType([
    T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType())),
])


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        both = np.array([mixed(s, 7).sum(dtype=np.uint64), mixed(s, 8).sum(dtype=np.uint64)], np.uint64)
    return tuple(both.view(np.int64).tolist())


def signature(s: np.ndarray) -> list[int]:
    odd = np.bincount((mixed(s, 9) >> np.uint64(64 - 9)).astype(np.int64), minlength=64 * len(SIGNATURE)) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def _bin(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), STEP):
            yield batch.iloc[at : at + STEP]


def _mark(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in _steps(batches):
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                s = shingle_set(word_hashes(text), k)
                np.add.at(counts, _bin(s), 1)
                rows.append((doc, len(s), *digest(s)))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "c1", "c2"]).assign(
                doc_id=batch["doc_id"].astype("Int64").values, segment=pd.array([None] * len(rows), "Int32"), counts=None
            )
        parts = counts.reshape(-1, SEGMENT)
        used = np.flatnonzero(parts.any(1))
        for at in range(0, len(used), SENT):
            some = used[at : at + SENT]
            empty = pd.array([None] * len(some), "Int64")
            yield pd.DataFrame({
                "doc_id": empty, "n": empty, "c1": empty, "c2": empty, "segment": pd.array(some, "Int32"),
                "counts": [parts[i].tobytes() for i in some],
            })

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, counts in zip(batch["segment"], batch["counts"]):
            got = np.frombuffer(counts, np.int64)
            sums[segment] = sums[segment] + got if segment in sums else got
    yield pd.DataFrame({"segment": pd.array(list(sums), "Int32"), "counts": [x.tobytes() for x in sums.values()]})


def sketch(marks: DataFrame) -> np.ndarray:
    """How many documents' shingles fall in each of 2 ** SKETCH_BITS bins; 8 MB at any input size."""
    rows = marks.where("segment is not null").select("segment", "counts")
    total = np.zeros((1 << SKETCH_BITS) // SEGMENT * SEGMENT, np.int64).reshape(-1, SEGMENT)
    spread = rows.repartition(F.col("segment"))
    for row in spread.mapInPandas(_summed, rows.schema).collect():
        total[row.segment] += np.frombuffer(row.counts, np.int64)
    return np.minimum(total.reshape(-1), 2**31 - 1).astype(np.int32)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _prefix(k: int, percent: int, frequency):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = frequency.value
        for batch in _steps(batches):
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                s = shingle_set(word_hashes(text), k)
                if len(s):
                    ranked = s[np.lexsort((s, often[_bin(s)]))][: prefix_length(len(s), percent)]
                    gid = mixed(np.array([digest(ranked)[0] + len(s)], np.int64).view(np.uint64)).view(np.int64)[0]
                    rows.append((doc, len(s), *digest(s), gid, ranked.view(np.int64), *signature(s)))
            out = pd.DataFrame(rows, columns=PREFIXES.names)
            yield out.assign(doc_id=pd.array(out["doc_id"], "Int64"))

    return run


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64), 3) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _sets(k: int, bitmap):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = bitmap.value
        for batch in _steps(batches):
            at = _bits(batch["doc_id"].fillna(0).to_numpy("int64"))
            wanted = batch[(flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            found = [shingle_set(word_hashes(text), k) for text in wanted["text"]]
            yield pd.DataFrame([(*digest(s), s.view(np.int64)) for s in found], columns=SETS.names)

    return run


def _flagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        at = _bits(batch["rep"].fillna(0).to_numpy("int64"))
        yield pd.DataFrame({"at": at >> 6, "bits": np.int64(1) << (at & 63)})


def bitmap_of(wanted: DataFrame) -> np.ndarray:
    """2 ** BITMAP_BITS bits, 2 MB, with those of the documents in ``wanted`` set."""
    rows = wanted.select("rep").mapInPandas(_flagged, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for batch in rows.toPandas().itertuples(index=False):
        words[batch.at] = batch.bits
    return words.view(np.uint8)


def shared_enough(shared: str, percent: int) -> str:
    """SQL: may sets of sizes na, nb with so many shared prefix shingles reach the similarity?

    Of the two, the set whose prefix ends first has all its common prefix shingles in
    the other's prefix, so the overlap is at most those plus what follows its prefix.
    """
    rest = [f"((({percent} * {n}) + 99) div 100 - 1)" for n in ("na", "nb")]
    return (
        f"100 * least(na, nb) >= {percent} * greatest(na, nb) and "
        f"{100 + percent} * ({shared} + greatest({rest[0]}, {rest[1]})) >= {percent} * (na + nb)"
    )


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the similarity, compared shingle by shingle.

    Prefixes are compared first; whole sets are read only for the pairs that remain.
    """
    side = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    other = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
    met = pairs.join(side, "a").join(other, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("shared"))
    pairs = stored(met.where(shared_enough("shared", percent)).select("a", "b", "na", "nb"), "pairs")
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(classes.join(used, "node").select("node", "c1", "c2", "rep"), "pair-nodes")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted))
    found = docs.mapInPandas(_sets(k, bitmap), SETS).join(wanted, ["c1", "c2"]).select("node", "shingles")
    sets = stored(found.dropDuplicates(["node"]), "pair-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    measured = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("common"))
    return stored(measured.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b"), "links")


def open_lists(lists: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of lists whose members are in more than one component, with the span of components of each group."""
    span = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    tagged = lists.join(span, "gid")
    mixed_tokens = tagged.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("token")
    return stored(tagged.join(mixed_tokens, "token"), "open-lists")


def candidates_of_leaders(lists: DataFrame, placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): each class with one class of the leading group that its group shares most with, if not yet connected."""
    chance = F.xxhash64("gid", "token", F.lit(turn))
    first = (F.col("pos") if turn % 2 == 0 else F.lit(0)).alias("first")
    leader = lists.groupBy("token").agg(F.min(F.struct(first, chance.alias("x"), "gid", "n", "low", "high")).alias("l")).select(
        "token", F.col("l.n").alias("nb"), F.col("l.gid").alias("lead"), F.col("l.low").alias("ll"), F.col("l.high").alias("lh")
    )
    apart = "gid <> lead and not (low = high and ll = lh and low = ll)"
    met = lists.withColumnRenamed("n", "na").join(leader, "token").where(apart).groupBy("gid", "lead", "na", "nb").agg(F.count("*").alias("shared"))
    best = met.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").groupBy("gid").agg(F.max(F.struct("shared", "lead")).alias("best"))
    one = placed.groupBy(F.col("gid").alias("lead")).agg(F.min("node").alias("one"))
    across = best.select("gid", F.col("best.lead").alias("lead")).join(one, "lead").join(placed.select("gid", "node"), "gid")
    return across.select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()


def close_enough(percent: int) -> str:
    """SQL: may two groups with signatures a, b be similar? Unequal bits are at most the shingles that only one set has.

    Counts are doubles here, exact for any set of fewer than 2 ** 44 shingles: sums of integers are checked for overflow
    one by one, and to compile that many checks in one join took an executor more than 100 MB that it did not give back.
    """
    unequal = " + ".join(f"double(bit_count({c}_a ^ {c}_b))" for c in SIGNATURE)
    return f"(several_a or several_b or {100 + percent}D * ({unequal}) <= {100 - percent}D * (double(n_a) + double(n_b)))"


def worth_comparing(percent: int) -> str:
    """SQL: may groups a, b that share a token have similar sets in different components? Each pair in one order only."""
    return (
        f"(n_a < n_b or n_a = n_b and gid_a < gid_b) and 100D * double(n_a) >= {percent}D * double(n_b) "
        "and not (low_a = high_a and low_b = high_b and low_a = low_b) "
        f"and {100 + percent}D * (double(least(pos_a, pos_b)) + least(double(n_a) - double(pos_a), double(n_b) - double(pos_b))) "
        f">= {percent}D * (double(n_a) + double(n_b)) "
        f"and {close_enough(percent)}"
    )


def candidates_across(lists: DataFrame, placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes of different components whose groups share a prefix shingle and have close signatures, or are one group.

    A group of several sets is not told apart by a signature, but by its members later.
    """
    signed = classes.join(lists.select("gid").distinct(), "gid", "left_semi").groupBy("gid").agg(
        (F.count("*") > 1).alias("several"), *[F.coalesce(F.first(c), F.lit(0).cast("long")).alias(c) for c in SIGNATURE]
    )
    lists = lists.join(signed, "gid")
    fields = ("gid", "n", "low", "high", "pos", "several", *SIGNATURE)
    leading = f"pos <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent}"
    a = lists.where(leading).select("token", *[F.col(c).alias(f"{c}_a") for c in fields])
    b = lists.select("token", *[F.col(c).alias(f"{c}_b") for c in fields])
    pairs = a.join(b, "token").where(worth_comparing(percent)).select("gid_a", "gid_b").distinct()
    span = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    split = span.where("low < high").select(F.col("gid").alias("gid_a"), F.col("gid").alias("gid_b"))
    left = placed.select(F.col("gid").alias("gid_a"), F.col("node").alias("a"), F.col("comp").alias("ca"))
    right = placed.select(F.col("gid").alias("gid_b"), F.col("node").alias("b"), F.col("comp").alias("cb"))
    return pairs.union(split).join(left, "gid_a").join(right, "gid_b").where("ca <> cb").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def jaccard_join(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents are linked when their sets of distinct ``k``-word shingles (A-Z
    lower-cased, words between ASCII white space; fewer words count as one shingle)
    have a Jaccard similarity of ``percent`` or more. ``component_id`` is the smallest
    doc_id reachable by links. Null, empty and blank texts have no shingles and are
    linked with nothing. Rows of equal sets are linked whatever their number and are
    compared once. Null ids take part but never name a component. An empty table gives
    an empty result; other columns are not looked at. Sets are compared by 64-bit
    shingle hashes.
    """
    with small_batches(docs.sparkSession):
        return _join(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), percent, k)


def _join(docs: DataFrame, percent: int, k: int) -> DataFrame:
    spark = docs.sparkSession
    marks = stored(docs.mapInPandas(_mark(k), MARKS), "shingle-marks")
    frequency = spark.sparkContext.broadcast(sketch(marks))
    prefixes = docs.mapInPandas(_prefix(k, percent, frequency), PREFIXES)
    classes = prefixes.groupBy("c1", "c2").agg(
        F.first("n").alias("n"), F.first("gid").alias("gid"), F.first("prefix").alias("prefix"), F.min("doc_id").alias("rep"),
        *[F.first(c).alias(c) for c in SIGNATURE],
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "shingle-classes")
    members = classes.select("gid", "node")
    later = members.join(members.groupBy("gid").agg(F.min("node").alias("one")), "gid").where("node <> one").select("node")
    groups = classes.join(later, "node", "left_anti").select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    common = stored(groups.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token"), "shared-tokens")
    lists = stored(groups.join(common, "token"), "prefix-lists")

    first = members.join(members.groupBy("gid").agg(F.min("node").alias("one")), "gid").where("node <> one")
    pairs = first.select(F.col("one").alias("a"), F.col("node").alias("b"))
    placed = members.withColumn("comp", F.col("node"))
    links, opened = None, lists
    for turn in range(ROUNDS):
        opened = open_lists(opened.select("token", "gid", "n", "pos"), placed)
        pairs = stored(pairs.union(candidates_of_leaders(opened, placed, turn, percent)).distinct(), "leader-pairs")
        found = verified(pairs, classes, docs, k, percent)
        links = found if links is None else links.union(found)
        component = stored(components(links), "components")
        placed = stored(members.join(component, "node", "left").select("gid", "node", F.coalesce("component", "node").alias("comp")), "placed")
        if 20 * found.count() < pairs.count():
            break
        pairs = pairs.limit(0)
    opened = open_lists(opened.select("token", "gid", "n", "pos"), placed)
    links = links.union(verified(candidates_across(opened, placed, classes, percent), classes, docs, k, percent))
    component = stored(components(links), "components")

    named = classes.select("c1", "c2", "node", "rep").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    named = named.join(smallest, "component").select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), "smallest")
    rows = marks.where("segment is null").select("doc_id", "n", "c1", "c2")
    joined = rows.join(named, (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")) & (F.col("n") > 0), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))


def keep_representatives(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group stays.

    Rows of one id stay or go together; null ids stay where they are linked with nothing.
    Null, empty and very long texts and empty tables are as in ``jaccard_join``; columns
    of any name are kept.
    """
    found = jaccard_join(docs, **parameters)
    stays = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(stays, docs[parameters.get("id_col", "doc_id")].eqNullSafe(stays["__id"]), "left_semi")
