"""Which tokens of two tokenizers stand for the same bytes.

Both tokenizations of a text tile the same bytes. A worker takes a block of
documents, lays their tokens end to end and sorts all of them by start; the running
maximum of the ends tells where a group ends: at a start that reaches it. Inside a
group every two tokens of different sides that overlap are a link.

How often two ids are linked is counted over the whole corpus. A block sends each of
its different id pairs once, with a count, and gets the corpus-wide count back, so
what is shuffled are distinct pairs per block and not links. A pair of ids occurs at
most once in a block: no key is hot. Blocks wait in Parquet, one row each, so a lost
executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import small_batches, stored
from chronomart.llm.encoders import BYTE_BPE, PIECE_BPE, ByteBpe, PieceBpe, byte_bpe, piece_bpe

#: A block ends with the document that brings it to so many bytes.
BLOCK = 4 << 20
#: A block is aligned in pieces that end with the document that brings them to so many bytes: what a worker holds at once.
PIECE = 1 << 18
#: An id pair is a << SIDE | b: ids of B are below 2 ** SIDE.
SIDE = 16

BLOCKS = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("doc_id", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("n_a", "n_b", "n_groups", "n_links")],
    T.StructField("groups_sha256", T.ArrayType(T.StringType())),
    T.StructField("links", T.BinaryType()), T.StructField("wide", T.BooleanType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())),
])
ROWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
    T.StructField("groups_sha256", T.StringType()),
])


def coalesced(start: np.ndarray, length: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of every token, all documents at once: a group breaks where a start reaches the largest end so far."""
    order = np.lexsort((side, start))
    end = np.maximum.accumulate((start + length)[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= end[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose ranges overlap, by A token. Either side is sorted and without gaps, so no run leaves its group."""
    first = np.searchsorted(b_end, a_start, "right")
    many = np.searchsorted(b_start, a_end, "left") - first
    a = np.repeat(np.arange(len(a_start)), many)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many - first, many)


def _sum_by(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact sums of consecutive runs that stop at ``ends``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[ends]
    return np.diff(total, prepend=0)


class Aligner:
    def __init__(self, a: ByteBpe, b: PieceBpe) -> None:
        if len(b.bytes) > 1 << SIDE:
            raise ValueError(f"tokenizer B has more than {1 << SIDE} ids")
        self.a, self.b = a, b
        self.a_size, self.b_size = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        self.ids = max(len(a.bytes), len(b.bytes))
        self.names = [b"%d%c" % (i, mark) for mark in b",|;" for i in range(self.ids)]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of either side; none where the joined bytes of a side are not those of space + text."""
        none = np.zeros(0, np.int64)
        a_ids, b_ids = [none] * len(texts), [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        for i, b in zip(full, self.b.encode([texts[i] for i in full])):
            data = b" " + texts[i].encode()
            if b"".join([self.b.bytes[x] for x in b]) != data:
                continue
            a = self.a.encode_plain(" " + texts[i])
            if b"".join([self.a.bytes[x] for x in a.tolist()]) == data:
                a_ids[i], b_ids[i] = a.astype(np.int64), np.array(b, np.int64)
        return a_ids, b_ids

    def block(self, texts: list[str | None], piece_bytes: int = PIECE) -> dict[str, object]:
        """Everything about a block that needs no other block."""
        pieces, first, held = [], 0, 0
        for stop, text in enumerate(texts, 1):
            held += len(text or "")
            if held >= piece_bytes or stop == len(texts):
                pieces.append(self.piece(texts[first:stop]))
                first, held = stop, 0
        pairs, place = np.unique(np.concatenate([p["pairs"] for p in pieces]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, np.concatenate([p["counts"] for p in pieces]))
        wide = len(pairs) > 1 << 16
        place, links, first = place.astype("<u4" if wide else "<u2"), [], 0
        for p in pieces:
            links.append(place[first : first + len(p["pairs"])][p["links"]].tobytes())
            first += len(p["pairs"])
        return {
            **{c: np.concatenate([p[c] for p in pieces]) for c in ("n_a", "n_b", "n_groups", "n_links")},
            "groups_sha256": [x for p in pieces for x in p["groups_sha256"]],
            "links": b"".join(links), "wide": wide, "pairs": pairs, "counts": counts,
        }

    def piece(self, texts: list[str | None]) -> dict[str, object]:
        """The same of some documents of a block; links are places in the pairs of the piece."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        side = np.repeat(np.array([0, 1], np.int8), (len(a), len(b)))
        group = coalesced(np.concatenate((a_start, b_start)), np.concatenate((a_end - a_start, b_end - b_start)), side)
        a_group, b_group = group[: len(a)], group[len(a) :]
        n_groups = len(a) and int(a_group[-1]) + 1
        a_in, b_in = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        # Group by group, first the A tokens, then the B tokens.
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[np.cumsum(a_in) - 1] = True
        b_last[np.cumsum(b_in) - 1] = True
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]] = a + self.ids * a_last
        code[np.arange(len(b)) + np.cumsum(a_in)[b_group]] = b + 2 * self.ids * b_last
        a_link, b_link = overlaps(a_start, a_end, b_start, b_end)
        pairs, links, counts = np.unique(a[a_link] << SIDE | b[b_link], return_inverse=True, return_counts=True)
        ends, a_ends = np.cumsum(n_a + n_b).tolist(), np.cumsum(n_a)
        digests = []
        for stop, n in zip(ends, (n_a + n_b).tolist()):
            text = b"".join([self.names[c] for c in code[stop - n : stop].tolist()])
            digests.append(sha256(text[:-1]).hexdigest() if n else "")
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": _sum_by(a_last, a_ends),
            "n_links": np.diff(np.searchsorted(a_link, a_ends, "left"), prepend=0), "groups_sha256": digests,
            "links": links.astype(np.min_scalar_type(len(pairs))), "pairs": pairs, "counts": counts,
        }


def _blocks(a_path: str, b_path: str, block_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(byte_bpe(a_path), piece_bpe(b_path))
        block = TaskContext.get().partitionId() << 32
        docs: list[int | None] = []
        texts: list[str | None] = []
        held = 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"block": [block], "doc_id": [docs], **{k: [v] for k, v in aligner.block(texts).items()}})

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                docs.append(None if pd.isna(doc) else int(doc))
                texts.append(text)
                held += len(text or "")
                if held >= block_bytes:
                    yield flush()
                    docs, texts, held, block = [], [], 0, block + 1
        if docs:
            yield flush()

    return run


def _sums(blocks: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block, given the corpus-wide counts of its pairs."""
    row = blocks.iloc[0]
    links = np.frombuffer(row["links"], "<u4" if row["wide"] else "<u2")
    order = np.argsort(known["pair"].to_numpy(np.int64))
    count, best = known["count"].to_numpy(np.int64)[order], known["best"].to_numpy(bool)[order]
    ends = np.cumsum(row["n_links"])
    n = {c: row[c] for c in ("n_a", "n_b", "n_groups", "n_links")}
    return pd.DataFrame({
        "doc_id": pd.array(list(row["doc_id"]), "Int64"), **n,
        "n_best": _sum_by(best[links], ends), "count_sum": _sum_by(count[links], ends),
        "groups_sha256": row["groups_sha256"],
    })


def aligned_blocks(
    docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK,
) -> DataFrame:
    """One stored row per block of documents: their groups, their links as places in ``pairs``, and how often the block links each pair."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return stored(rows.mapInPandas(_blocks(a_path, b_path, block_bytes), BLOCKS), "alignment", compression="zstd")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")
    )


def _counted(blocks: DataFrame) -> DataFrame:
    counts = _block_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << SIDE) - 1))
    # One row per id of B, at most 2 ** SIDE: the size bound of the broadcast.
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def token_map(blocks: DataFrame) -> DataFrame:
    """How often each two ids are linked corpus-wide: a_id, b_id, count, best (no A id is linked with this B id more often)."""
    pair = F.col("pair")
    return _counted(blocks).select(
        F.shiftright(pair, SIDE).cast("int").alias("a_id"), pair.bitwiseAND(F.lit((1 << SIDE) - 1)).cast("int").alias("b_id"), "count", "best"
    )


def align(
    docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK,
) -> DataFrame:
    """One row per document: counts of tokens, groups and links, links whose count is the best of their B id, the sum of counts, and a digest of the groups.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte
    (U+2581 turns into a space), have zeros and an empty digest, and so count nowhere.
    Texts are aligned whole: a text longer than ``block_bytes`` is a block of its own,
    and a block with it holds one text. Repeated rows count each time; equal counts are
    all best; null ids stay null; an empty table gives no rows; columns other than id
    and text are not read, whatever their names.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col, block_bytes)
    known = _block_pairs(blocks).join(_counted(blocks), "pair").select(F.col("block").alias("of"), "pair", "count", "best")
    own = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "wide")
    return own.groupBy("block").cogroup(known.groupBy("of")).applyInPandas(_sums, ROWS)
