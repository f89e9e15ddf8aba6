"""Near-duplicate embeddings by collision counting over sorted one-dimensional projections.

Vectors are scaled to length one; equal vectors become one node. Nodes are placed in
``tables`` tables of cells by the signs of random hyperplanes, so that work is spread
and stays near linear. Within a cell, every one of ``PROJECTIONS`` Gaussian projections
is sorted, and for each vector the others inside a window around its own value collide
with it. Pairs with enough collisions are verified by cosine in double precision. A
pair counts in the first table that holds both.

Pairs don't leave the block that finds them: a group of near copies has as many as the
square of its size. A block gives one row for each node that it links: how many rows the
node is linked with there, and the smallest node that it reaches there.

For a pair at the threshold, a projection's difference is normal with a known standard
deviation, which gives the window, the count that all but a hundredth of such pairs
reach, and the number of tables: closer pairs collide more often.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import components, stored

PROJECTIONS = 24
#: Half window in standard deviations of the difference of a pair at the threshold.
WINDOW = 1.6
#: A pair at the threshold is missed by the count, and by all tables, at most so often.
MISS_COUNT, MISS_TABLES = 0.01, 0.01
#: Nodes that a cell should hold on average, and nodes of a block where a cell holds more than two blocks.
CELL, BLOCK = 192, 768
#: Pairs that are verified at once.
AT_ONCE = 1 << 15

PLACED = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("v", T.BinaryType()), T.StructField("copies", T.LongType()),
    T.StructField("t", T.IntegerType()), T.StructField("cell", T.LongType()),
])
LINKS = T.StructType([T.StructField(c, T.LongType()) for c in ("node", "linked", "root")])


def calibrated(n: int, cosine: float) -> tuple[int, int, float, int]:
    """(bits of a cell, tables, half window, collisions asked for) for ``n`` vectors."""
    bits = max(2, min(24, round(math.log2(max(n, 1) / CELL))))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    tables = math.ceil(math.log(MISS_TABLES) / math.log(1 - together))
    p = math.erf(WINDOW / math.sqrt(2))
    below, count = 0.0, 0
    while below + (term := math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)) <= MISS_COUNT:
        below, count = below + term, count + 1
    return bits, tables, WINDOW * math.sqrt(2 - 2 * cosine), count


class Geometry:
    """The random directions, the same in every task."""

    def __init__(self, dim: int, bits: int, tables: int, seed: int) -> None:
        draw = np.random.default_rng([seed, dim])
        self.lines = draw.standard_normal((dim, PROJECTIONS))
        self.planes = draw.standard_normal((dim, tables * bits))
        self.bits, self.tables = bits, tables

    def cells(self, v: np.ndarray) -> np.ndarray:
        signs = (v @ self.planes > 0).reshape(len(v), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def _vectors(values, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dim)


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the unit vector as bytes, null where there is none."""
    for batch in batches:
        out = []
        for x in batch["x"]:
            v = None if x is None else np.asarray(x, np.float64)
            top = 0.0 if v is None or not len(v) else np.abs(v).max()
            if not np.isfinite(top) or top == 0:
                out.append(None)
            else:
                v = v / top
                out.append((v / np.sqrt(v @ v)).tobytes())
        yield pd.DataFrame({"id": batch["id"], "v": out})


def _place(dim: int, bits: int, tables: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space = Geometry(dim, bits, tables, seed)
        for batch in batches:
            if len(batch):
                cells = space.cells(_vectors(batch["v"], dim))
                for t in range(tables):
                    yield pd.DataFrame({**batch[["node", "v", "copies"]], "t": np.int32(t), "cell": cells[:, t]})

    return run


def reached(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """The smallest of 0 to ``size`` - 1 that each of them reaches over the links (i, j)."""
    low = np.arange(size)
    while True:
        before = low.copy()
        least = np.minimum(low[i], low[j])
        np.minimum.at(low, before[i], least)
        np.minimum.at(low, before[j], least)
        np.minimum.at(low, i, least)
        np.minimum.at(low, j, least)
        low = low[low]
        if (low == before).all():
            return low


def _collide(dim: int, bits: int, tables: int, seed: int, window: float, count: int, cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        space, t = Geometry(dim, bits, tables, seed), int(rows["t"].iloc[0])
        rows = rows.sort_values("node")
        v, nodes, side = _vectors(rows["v"], dim), rows["node"].to_numpy(), rows["side"].to_numpy()
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        hits = np.zeros((len(left), len(right)), np.uint8)
        for line in (v @ space.lines).T:
            order = np.argsort(line[right], kind="stable")
            values = line[right][order]
            first = np.searchsorted(values, line[left] - window, "left")
            end = np.searchsorted(values, line[left] + window, "right")
            edges = np.zeros((len(left), len(right) + 1), np.int8)
            np.add.at(edges, (np.arange(len(left)), first), 1)
            np.add.at(edges, (np.arange(len(left)), end), -1)
            inside = np.cumsum(edges[:, :-1], axis=1, dtype=np.int8)
            hits[:, order] += inside.view(np.uint8)
        i, j = np.nonzero(hits >= count)
        i, j = left[i], right[j]
        if side[0] == 0:
            i, j = i[i < j], j[i < j]
        cells, near = space.cells(v)[:, :t], np.zeros(len(i), bool)
        for at in range(0, len(i), AT_ONCE):
            a, b = i[at : at + AT_ONCE], j[at : at + AT_ONCE]
            new = (np.einsum("ij,ij->i", v[a], v[b]) >= cosine) & ~(cells[a] == cells[b]).any(axis=1)
            near[at : at + AT_ONCE] = new
        i, j = i[near], j[near]
        copies, linked = rows["copies"].to_numpy(), np.zeros(len(nodes), np.int64)
        np.add.at(linked, i, copies[j])
        np.add.at(linked, j, copies[i])
        met = np.flatnonzero(linked)
        return pd.DataFrame({"node": nodes[met], "linked": linked[met], "root": nodes[reached(i, j, len(nodes))[met]]})

    return run


def near_links(nodes: DataFrame, dim: int, n: int, cosine: float, seed: int) -> DataFrame:
    """(node, linked, root): in one block ``node`` is linked with ``linked`` rows and reaches ``root``, the smallest.

    Nodes whose vectors have at least the cosine are linked; each pair counts in one block only.

    A cell of more than two blocks is cut by hash into blocks; every two blocks of it
    meet in one task, whose size is fixed.
    """
    bits, tables, window, count = calibrated(n, cosine)
    placed = nodes.mapInPandas(_place(dim, bits, tables, seed), PLACED)
    sizes = nodes.mapInPandas(_place(dim, bits, tables, seed), PLACED).groupBy("t", "cell").agg(F.count("*").alias("held")).where("held > 1")
    parts = F.when(F.col("held") <= 2 * BLOCK, F.lit(1)).otherwise(F.ceil(F.col("held") / BLOCK)).cast("int")
    sized = stored(sizes.select("t", "cell", parts.alias("parts")), "cells")
    rows = placed.join(sized, ["t", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    met = rows.select("node", "v", "copies", "t", "cell", F.expr("""inline(transform(sequence(0, parts - 1), p -> named_struct(
        'pi', least(p, part), 'pj', greatest(p, part), 'side', sign(part - p) * if(p = part, 0, 1))))"""))
    met = met.withColumn("side", F.col("side").cast("int"))
    return met.groupBy("t", "cell", "pi", "pj").applyInPandas(_collide(dim, bits, tables, seed, window, count, cosine), LINKS)


def embedding_dedup(vectors: DataFrame, cosine: float = 0.9, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows at the cosine or above that were found, equal
    ones included; ``component_id`` is the smallest id reachable by links; ``kept`` marks
    the rows that name their component. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and neither do vectors of different
    lengths with each other. Null ids take part but never name a component. Repeated
    rows are separate vectors. An empty table gives an empty result; other columns are
    not looked at. At the threshold itself about two in a hundred pairs are missed,
    fewer the closer a pair is; no pair below it is linked.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    unit = stored(rows.mapInPandas(_unit, "id long, v binary"), "unit-vectors")
    nodes = unit.where("v is not null").groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    links = None
    for size, n in nodes.groupBy(F.octet_length("v")).count().collect():
        own = near_links(nodes.where(F.octet_length("v") == size).select("node", "v", "copies"), size // 8, n, cosine, seed)
        links = own if links is None else links.union(own)
    if links is None:
        return unit.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = stored(links, "vector-links")
    component = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    placed = nodes.join(linked, "node", "left").join(component, "node", "left")
    placed = placed.select("v", "copies", "least", "linked", F.coalesce("component", "node").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("smallest"))
    named = placed.join(smallest, "component").select(F.col("v").alias("w"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"), "smallest")
    out = unit.join(named, F.col("v") == F.col("w"), "left")
    top = F.coalesce("smallest", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), top.alias("component_id"),
        F.col("id").eqNullSafe(top).alias("kept"),
    )
