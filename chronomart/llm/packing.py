"""Documents packed into as few token sequences as possible, with proof where no fewer are possible.

Workers encode documents and cut them into pieces of at most ``capacity`` tokens.
Pieces come in parts of bounded size. A part is packed by best-fit decreasing, and
dual-feasible functions give a lower bound of its bins: a part that meets its bound is
certified. The others, and the emptiest bin of every part, give up the documents of
their bins that are not full; these are dealt into new parts and packed again, until
no part has a gap and all that is left fits in one part, or a round saves no bin.

A round is accepted only if it saves bins, so more rounds never pack worse. What
passes through the driver is one line of totals per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import stored
from chronomart.llm.encoders import BYTE_BPE, byte_bpe

CAPACITY = 2048
#: Fixed value: the id that ends a document.
END = 0
#: Pieces of a part, what one task packs at once.
PART = 1 << 15
#: A sequence id is round, part and bin; a part has fewer than 2 ** BINS bins.
BINS, PARTS = 18, 38
#: The functions u(1) to u(FUNCTIONS) are tried, besides the thresholds.
FUNCTIONS = 100

PIECES = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("item", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])
PLACED = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("item", T.IntegerType()), T.StructField("length", T.LongType()),
    T.StructField("own", T.LongType()), T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("free", T.LongType()), T.StructField("bins", T.LongType()), T.StructField("bound", T.LongType()),
    T.StructField("slack", T.BooleanType()),
])


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Where the pieces of ``n`` tokens start and the last one ends: full pieces, the first one shorter."""
    return [0, *range(n % capacity or capacity, n + 1, capacity)]


def lower_bound(many: np.ndarray, capacity: int = CAPACITY) -> int:
    """The largest bound that dual-feasible functions give for the number of bins; ``many`` pieces of each length from 0 to capacity.

    Thresholds: a piece longer than capacity - t counts as a bin, one shorter than t as
    nothing. u(k): (k + 1) * length rounded down to whole bins, over k, unless it is whole.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    below, weight = np.concatenate(([0], np.cumsum(many))), np.concatenate(([0], np.cumsum(many * x)))
    t = np.arange(capacity // 2 + 1)
    large = below[-1] - below[capacity - t + 1]
    best = int(np.max(-(-(capacity * large + weight[capacity - t + 1] - weight[t]) // capacity)))
    for k in range(1, FUNCTIONS + 1):
        whole, rest = np.divmod(x * (k + 1), capacity)
        # In units of 1 / (k * capacity) of a bin, so that all sums are whole.
        value = np.where(rest == 0, x * k, whole * capacity)
        best = max(best, -(-int((many * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece and the free room of every bin; equal lengths in given order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Bit r is set while some bin has room r.
    rooms, free = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = at, capacity - room
        free[at] = room = room - length
        if room:
            open_bins[room].append(at)
            rooms |= 1 << room
    return bins, offsets, np.array(free, np.int64)


def _packer(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "item"]).reset_index(drop=True)
        lengths = rows["length"].to_numpy(np.int64)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        if len(free) >= 1 << BINS:
            raise ValueError("a part has too many bins")
        return rows[["part", "item", "length", "own"]].assign(
            bin=bins, offset=offsets, free=free[bins], bins=len(free), bound=bound, slack=bins == int(np.argmax(free)),
        )

    return pack


def _cutter(path: str, end: int, capacity: int, part_pieces: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path)
        part, item = TaskContext.get().partitionId() << 16, 0
        for batch in batches:
            for k in range(0, len(batch), 512):
                rows = []
                for doc, text in zip(batch["doc_id"].iloc[k : k + 512], batch["text"].iloc[k : k + 512]):
                    ids = np.append(bpe.encode(text or ""), end).astype("<u4")
                    at = cuts(len(ids), capacity)
                    for n, (start, stop) in enumerate(zip(at, at[1:])):
                        rows.append((part, item, None if pd.isna(doc) else int(doc), n, start, stop - start, ids[start:stop].tobytes()))
                        item += 1
                        if item == part_pieces:
                            part, item = part + 1, 0
                out = pd.DataFrame(rows, columns=PIECES.names)
                yield out.assign(doc_id=pd.array(out["doc_id"], "Int64"))

    return run


def pieces(
    docs: DataFrame, path: str = BYTE_BPE, end: int = END, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    part_pieces: int = PART,
) -> DataFrame:
    """The pieces of all documents, stored: part and item name a piece, ``ids`` are little-endian unsigned 32-bit integers.

    A text is encoded whole, ``end`` after it; null counts as empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = rows.mapInPandas(_cutter(path, end, capacity, part_pieces), PIECES)
    return stored(cut.withColumn("ids_crc32", F.crc32("ids")), "pieces", compression="zstd")


def _packed(rows: DataFrame, capacity: int) -> DataFrame:
    return stored(rows.groupBy("own").applyInPandas(_packer(capacity), PLACED), "packed")


def _total_bins(placed: DataFrame) -> int:
    return placed.groupBy("own").agg(F.first("bins").alias("bins")).agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]


def place(cut: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART) -> DataFrame:
    """Where each piece goes: part, item, sequence_id, offset, and the bins and bound of the part it was packed with last."""
    keys = ["part", "item"]
    name = lambda turn: F.lit(turn << (BINS + PARTS)) + F.shiftleft("own", BINS) + F.col("bin")
    out = ["part", "item", "length", "sequence_id", "offset", "bins", "bound"]
    placed = _packed(cut.select(*keys, "length", F.col("part").alias("own")), capacity)
    done, turn = [], 0
    while True:
        # Of a certified part only the emptiest bin can be of use to others.
        given = (F.col("free") > 0) & ((F.col("bins") > F.col("bound")) | F.col("slack"))
        loose = placed.where(given)
        n, parts, bins = loose.agg(F.count("*"), F.countDistinct("own"), F.countDistinct("own", "bin")).first()
        named = placed.withColumn("sequence_id", name(turn))
        groups = -(-n // part_pieces)
        again = None
        if parts > 1:
            dealt = F.pmod(F.xxhash64(*keys, F.lit(turn)), F.lit(groups)).cast("long")
            again = _packed(loose.select(*keys, "length", dealt.alias("own")), capacity)
        if again is None or _total_bins(again) >= bins:
            done.append(named.select(*out))
            break
        done.append(named.where(~given).select(*out))
        placed, turn = again, turn + 1
    places = done[0]
    for other in done[1:]:
        places = places.unionByName(other)
    return places


def pack(
    docs: DataFrame, path: str = BYTE_BPE, end: int = END, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    part_pieces: int = PART,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    Null and empty texts are a piece of the end id alone; a text of more than
    ``capacity`` tokens, however long, gives full pieces and a first one with the rest;
    equal texts and repeated rows are packed one by one, equal lengths in stored order;
    null ids stay null; an empty table gives no rows; columns other than id and text are
    not read, whatever their names. Sequence ids are any numbers.
    """
    cut = pieces(docs, path, end, capacity, id_col, text_col, part_pieces)
    return cut.join(place(cut, capacity, part_pieces).drop("length"), ["part", "item"]).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ids, and the documents in them with their places. At most ``capacity`` tokens meet in a group."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    joined = F.aggregate("inside", F.lit(b""), lambda all_ids, one: F.concat(all_ids, one["ids"]))
    return packed.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id", joined.alias("ids"), F.transform("inside", lambda x: x.dropFields("ids")).alias("documents")
    )


def fill(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences, how few there could be at all). The lengths come as one count each, at most ``capacity`` of them."""
    many = np.zeros(capacity + 1, np.int64)
    for row in packed.groupBy("length").agg(F.count("*").alias("n")).collect():
        many[row["length"]] = row["n"]
    return packed.select("sequence_id").distinct().count(), lower_bound(many, capacity)
