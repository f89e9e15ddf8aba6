"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). Frequent words are classes of
their own, the others share classes by their ending. The class is predicted by a
softmax over hashed n-gram and skip features of the history; a word inside its class
has its add-one unigram probability, so unseen words keep a place. Weights are trained
by distributed gradient updates: in each round the training documents are dealt by a
hash to shards of about ``SHARD`` tokens, every shard makes updates from the common
weights, and the results are averaged by tokens. So scores do not follow the files.

Word counts cover all training documents. They are summed in shards of the hash space;
only words with a 2 ** -HOT_BITS share of all tokens, so at most 2 ** HOT_BITS of them,
are broadcast. All other words of a document are looked up in their shard, packed in
blocks of documents, and the sums come back per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import stored
from chronomart.llm.shingles import mixed, together, words_of_all

HOT_BITS = 16
#: Classes: the end, OWN frequent words, ENDINGS shared ones.
OWN, ENDINGS = 32, 31
CLASSES = 1 + OWN + ENDINGS  # 64, a power of two
#: Rows of the weight table: always on, then hashed features of each kind.
KINDS = (CLASSES, 4096, 2048, 2048, 1024)
FEATURES = 1 + sum(KINDS)
BATCH, RATE, ROUNDS = 8192, 0.35, 1
#: Weights are averaged over shards of so many training tokens, in so many shards at most: larger ones then.
SHARD, SHARDS = 1 << 21, 1 << 15
DOCS = 1024
#: Sums of logarithms are whole units, so that they are equal under any partitioning.
UNIT = 1e12
END_HASH = np.uint64(0xE4D)
CHUNK = 512
#: Tokens whose class scores stay in a core's cache; scores up to SAFE need no shift before their exponentials.
CACHED, SAFE = 512, 40
#: Rows of a run of equal features that are added step by step with those of all other runs.
STEPS = 32

_FIRST = 1 + np.cumsum((0, *KINDS))
#: What is hashed from a few values has a table: the shared class by a word's last two bytes, rows by two classes.
_ENDING = (mixed(np.arange(1 << 16, dtype=np.uint64), 5) % np.uint64(ENDINGS)).astype(np.uint8)
_PAIR, _SKIP = (
    (mixed(np.arange(CLASSES**2, dtype=np.uint64), salt) % np.uint64(KINDS[k]) + np.uint64(_FIRST[k])).astype(np.uint16) for k, salt in ((1, 11), (3, 12))
)


def features(classes: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of documents with so many words, their ends included: (kinds, tokens) rows of the weight table, and its class.

    Row 0 of the table, which is always on, is left out. The history before the first
    word of a document is filled with the end.
    """
    # Each document has three ends before its words and one after them.
    lead = 4 * np.arange(len(counts))
    at = np.arange(len(classes)) + np.repeat(lead + 3, counts)
    c, h = np.zeros(len(classes) + 4 * len(counts), np.uint16), np.full(len(classes) + 4 * len(counts), END_HASH)
    c[at], h[at] = classes, hashes
    token = np.ones(len(c), bool)
    token[(lead + np.cumsum(counts) - counts)[:, None] + np.arange(3)] = False
    token = np.flatnonzero(token)
    two = c * np.uint16(CLASSES)
    two[1:] += c[:-1]
    out = np.empty((len(KINDS), len(token)), np.uint16)
    before, last = token - 1, token - 2
    out[0] = c[before] + np.uint16(_FIRST[0])
    out[1] = _PAIR[two[before]]
    out[2] = ((mixed(h, 13) & np.uint64(KINDS[2] - 1)).astype(np.uint16) + np.uint16(_FIRST[2]))[before]
    out[3] = _SKIP[two[last]]
    out[4] = ((mixed(h, 14) & np.uint64(KINDS[4] - 1)).astype(np.uint16) + np.uint16(_FIRST[4]))[last]
    return out, c[token].astype(np.int64)


def run_sums(values: np.ndarray, first: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Sums of runs of rows that start at ``first``, of ``values`` or of ``values[at]``.

    All runs add a row at each step; what is left of the few long ones is summed by products with a vector of ones.
    """
    at = np.arange(len(values)) if at is None else at
    length = np.diff(np.append(first, len(at)))
    longest = np.argsort(-length, kind="stable")
    first, length = first[longest], length[longest]
    sums = values[at[first]]
    for step in range(1, min(length[0], STEPS)):
        going = np.searchsorted(-length, -step)
        sums[:going] += values[at[first[:going] + step]]
    ones = np.ones(length[0], values.dtype)
    for run in range(np.searchsorted(-length, -STEPS)):
        left = values[at[first[run] + STEPS : first[run] + length[run]]]
        sums[run] += ones[: len(left)] @ left
    out = np.empty_like(sums)
    out[longest] = sums
    return out


def exponentials(w: np.ndarray, rows: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials of the class scores, their sums, the score of each target).

    Where some score of a step lies beyond ``SAFE``, the largest of each token is set to 0 first, so none overflows.
    """
    out, sums, own = np.empty((len(target), CLASSES), w.dtype), np.empty(len(target), w.dtype), np.empty(len(target), w.dtype)
    ones, term = np.ones(CLASSES, w.dtype), np.empty((min(len(target), CACHED), CLASSES), w.dtype)
    for k in range(0, len(target), CACHED):
        z, y = out[k : k + CACHED], target[k : k + CACHED]
        more = term[: len(y)]
        np.take(w, rows[0, k : k + CACHED], 0, out=z, mode="clip")
        for row in rows[1:, k : k + CACHED]:
            z += np.take(w, row, 0, out=more, mode="clip")
        z += w[0]
        if not (-SAFE < z.min() and z.max() < SAFE):
            z -= z.max(1, keepdims=True)
        own[k : k + CACHED] = z[np.arange(len(y)), y]
        np.exp(z, out=z)
        np.dot(z, ones, out=sums[k : k + CACHED])
    return out, sums, own


def update(w: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One gradient step on a batch; a row moves by its mean error, so rare features move as far as frequent ones."""
    error, sums, _ = exponentials(w, rows, target)
    error /= sums[:, None]
    error[np.arange(len(target)), target] -= 1
    w[0] -= RATE * error.sum(0) / (len(target) + 4)
    # Kinds have rows of their own, so all are moved at once; 16-bit keys are sorted by radix.
    key = rows.ravel()
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))[:, None]
    w[key[first]] -= run_sums(error, first, np.tile(np.arange(len(target)), len(rows))[order]) * (RATE / (count + 4)).astype(np.float32)


class Model:
    """What scoring needs besides the weights; its size is bounded by 2 ** HOT_BITS words."""

    def __init__(self, n: int, v: int, train_docs: int, hot: np.ndarray, counts: np.ndarray, endings: np.ndarray, in_ending: np.ndarray, of_ending: np.ndarray) -> None:
        order = np.argsort(hot)
        self.n, self.v, self.end = n, v, train_docs
        self.hot, self.counts = hot[order], counts[order]
        top = np.lexsort((self.hot, -self.counts))[:OWN]
        own = np.zeros(len(self.hot), np.int64)
        own[top] = np.arange(1, 1 + len(top))
        self.own = np.append(own, 0)
        z = np.ones(CLASSES)
        z[0] += train_docs + (train_docs > 0)
        z[1 : 1 + len(top)] += self.counts[top] + 1
        lost = np.bincount(endings[order][top], self.counts[top], ENDINGS), np.bincount(endings[order][top], minlength=ENDINGS)
        z[1 + OWN :] += in_ending - lost[0] + of_ending - lost[1]
        self.log_z = np.log10(z)
        self.log_counts = np.rint(np.log10(self.counts + 1.0) * UNIT).astype(np.int64)
        self.start = np.log(np.maximum(z, 1) / np.maximum(z, 1).sum()).astype(np.float32)

    def initial(self) -> np.ndarray:
        w = np.zeros((FEATURES, CLASSES), np.float32)
        w[0] = self.start
        return w

    def read(self, texts: list[str | None]):
        """(hashes, classes, place among the hot words or -1) of the words of all texts, and how many words each text has."""
        hashes, tails, counts = words_of_all(texts)
        place = np.full(len(hashes), -1)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
            place = np.where(self.hot[at] == hashes, at, -1)
        own = self.own[place]
        return hashes, np.where(own > 0, own, 1 + OWN + _ENDING[tails].astype(np.int64)), place, counts


def _count(shard_bits: int):
    def packed(u: np.ndarray, c: np.ndarray, e: np.ndarray) -> pd.DataFrame:
        shard = (u >> np.uint64(63)) * 0 if not shard_bits else u >> np.uint64(64 - shard_bits)
        used, first = np.unique(shard, return_index=True)
        ends = np.append(first[1:], len(u))
        return pd.DataFrame({
            "shard": used.astype(np.int64), "u": [u[i:j].tobytes() for i, j in zip(first, ends)],
            "c": [c[i:j].tobytes() for i, j in zip(first, ends)], "e": [e[i:j].tobytes() for i, j in zip(first, ends)],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, c, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        for batch in batches:
            for k in range(0, len(batch), CHUNK):
                found = [words_of_all(texts) for texts in together(batch["text"].iloc[k : k + CHUNK])]
                both = np.concatenate([u, *[hashes for hashes, _, _ in found]])
                count = np.concatenate([c, np.ones(len(both) - len(c), np.int64)])
                ending = np.concatenate([e, *[_ENDING[tails] for _, tails, _ in found]])
                u, first, inverse = np.unique(both, return_index=True, return_inverse=True)
                c, e = np.bincount(inverse, count, len(u)).astype(np.int64), ending[first]
                if len(u) > 1 << 21:
                    yield packed(u, c, e)
                    u, c, e = u[:0], c[:0], e[:0]
        if len(u):
            yield packed(u, c, e)

    return run


def _sum_shard(rows: pd.DataFrame) -> pd.DataFrame:
    u = np.frombuffer(b"".join(rows["u"]), np.uint64)
    c, e = np.frombuffer(b"".join(rows["c"]), np.int64), np.frombuffer(b"".join(rows["e"]), np.uint8)
    u, first, inverse = np.unique(u, return_index=True, return_inverse=True)
    c, e = np.bincount(inverse, c, len(u)).astype(np.int64), e[first]
    per = np.bincount(e, c, ENDINGS).astype(np.int64), np.bincount(e, minlength=ENDINGS).astype(np.int64)
    return pd.DataFrame({
        "shard": [rows["shard"].iloc[0]], "n": [c.sum()], "v": [len(u)], "u": [u.tobytes()], "c": [c.tobytes()],
        "e": [e.tobytes()], "in_ending": [per[0].tolist()], "of_ending": [per[1].tolist()],
    })


def _hot(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for u, c, e in zip(batch["u"], batch["c"], batch["e"]):
                c = np.frombuffer(c, np.int64)
                at = np.flatnonzero(c >= least)
                yield pd.DataFrame({"u": np.frombuffer(u, np.uint64)[at].view(np.int64), "c": c[at], "e": np.frombuffer(e, np.uint8)[at].astype(np.int32)})

    return run


def _train(model, weights):
    """Updates over a shard's training documents; returns its weights, in slices of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, w, tokens = model.value, weights.value.copy(), 0
        rows: list[np.ndarray] = []
        target: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            nonlocal tokens
            x, y = np.concatenate(rows, axis=1), np.concatenate(target)
            for k in range(0, len(y), BATCH):
                update(w, x[:, k : k + BATCH], y[k : k + BATCH])
            tokens += len(y)

        for batch in batches:
            for texts in together(batch["text"]):
                hashes, classes, _, counts = m.read(texts)
                x, y = features(classes, hashes, counts)
                start = 0
                for end in np.cumsum(counts + 1):
                    if held + end - start >= 16 * BATCH:
                        rows.append(x[:, start:end])
                        target.append(y[start:end])
                        flush()
                        rows, target, held, start = [], [], 0, end
                rows.append(x[:, start:])
                target.append(y[start:])
                held += len(y) - start
        if held:
            flush()
        if tokens:
            for k in range(0, FEATURES, CHUNK):
                yield pd.DataFrame({"slice": [k], "tokens": [tokens], "sums": [w[k : k + CHUNK].tobytes()]})

    return run


def _averaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    tokens: dict[int, int] = {}
    for batch in batches:
        for k, n, data in zip(batch["slice"], batch["tokens"], batch["sums"]):
            got = np.frombuffer(data, np.float32).astype(np.float64) * n
            sums[k] = sums[k] + got if k in sums else got
            tokens[k] = tokens.get(k, 0) + n
    yield pd.DataFrame({"slice": list(sums), "tokens": list(tokens.values()), "sums": [x.tobytes() for x in sums.values()]})


BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("docs", T.IntegerType()),
    T.StructField("u", T.BinaryType()), T.StructField("word", T.BinaryType()), T.StructField("doc", T.BinaryType()),
    T.StructField("times", T.BinaryType()), T.StructField("idx", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
    T.StructField("logs", T.LongType()), T.StructField("model", T.DoubleType()),
])
SUMS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("known", T.BinaryType()), T.StructField("logs", T.BinaryType()),
])


def _score(model, weights, shard_bits: int):
    """Per document what needs no look-up, and per block and shard the packed words to be looked up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, w = model.value, weights.value
        log_counts = np.append(m.log_counts, 0)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(0, len(batch), DOCS):
                part = batch.iloc[k : k + DOCS]
                block += 1
                sizes, known, logs, scores, rare, whose, done = [], [], [], [], [], [], 0
                for texts in together(part["text"]):
                    hashes, classes, place, counts = m.read(texts)
                    x, y = features(classes, hashes, counts)
                    each = np.empty(len(y))
                    for at in range(0, len(y), BATCH):
                        _, sums, own = exponentials(w, x[:, at : at + BATCH], y[at : at + BATCH])
                        each[at : at + BATCH] = own - np.log(sums)
                    ends = np.cumsum(counts)
                    first = ends - counts + np.arange(len(counts))
                    scores.append(np.add.reduceat(each, first) / math.log(10) - np.add.reduceat(m.log_z[y], first))
                    cold = place < 0
                    so_far = np.cumsum([np.append(0, ~cold), np.append(0, np.where(cold, 0, log_counts[place]))], 1)
                    of_all = so_far[:, ends] - so_far[:, ends - counts]
                    sizes.append(counts + 1)
                    known.append(of_all[0] + (m.end > 0))
                    logs.append(of_all[1] + round(math.log10(m.end + 1) * UNIT))
                    rare.append(hashes[cold])
                    whose.append(np.repeat(np.arange(done, done + len(counts), dtype=np.uint64), counts)[cold])
                    done += len(counts)
                yield pd.DataFrame({
                    "block": block, "docs": len(part), "idx": np.arange(len(part)), "doc_id": part["doc_id"].astype("Int64").values,
                    "held_out": part["held_out"].values, "n_tokens": np.concatenate(sizes), "known": np.concatenate(known),
                    "logs": np.concatenate(logs), "model": np.concatenate(scores),
                }).reindex(columns=BLOCKS.names).astype({"shard": "Int64"})
                words = np.concatenate(rare)
                u, inverse = np.unique(words, return_inverse=True)
                keys, times = np.unique(inverse.astype(np.uint64) * np.uint64(DOCS) + np.concatenate(whose), return_counts=True)
                word, doc = (keys // np.uint64(DOCS)).astype(np.uint32), (keys % np.uint64(DOCS)).astype(np.uint16)
                shard = u >> np.uint64(64 - shard_bits) if shard_bits else np.zeros(len(u), np.uint64)
                used, first = np.unique(shard, return_index=True)
                ends = np.append(first[1:], len(u))
                cut = np.searchsorted(word, np.append(first, len(u)))
                if len(used):
                    yield pd.DataFrame({
                        "block": block, "shard": used.astype(np.int64), "docs": len(part), "u": [u[i:j].tobytes() for i, j in zip(first, ends)],
                        "word": [(word[a:b] - i).astype(np.uint32).tobytes() for a, b, i in zip(cut, cut[1:], first)],
                        "doc": [doc[a:b].tobytes() for a, b in zip(cut, cut[1:])],
                        "times": [times[a:b].astype(np.uint16 if times.max() < 65536 else np.uint32).tobytes() for a, b in zip(cut, cut[1:])],
                    }).reindex(columns=BLOCKS.names).astype({"idx": "Int32", "doc_id": "Int64", "n_tokens": "Int64", "known": "Int64", "logs": "Int64"})

    return run


def _look_up(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    u = np.frombuffer(counts["u"].iloc[0], np.uint64) if len(counts) else np.zeros(0, np.uint64)
    c = np.frombuffer(counts["c"].iloc[0], np.int64) if len(counts) else np.zeros(0, np.int64)
    out = []
    for block, docs, own, word, doc, times in zip(*(blocks[x] for x in ("block", "docs", "u", "word", "doc", "times"))):
        own, word, doc = np.frombuffer(own, np.uint64), np.frombuffer(word, np.uint32), np.frombuffer(doc, np.uint16)
        times = np.frombuffer(times, np.uint16 if len(times) == 2 * len(doc) else np.uint32).astype(np.int64)
        found = np.zeros(len(own), np.int64)
        if len(u):
            at = np.minimum(np.searchsorted(u, own), len(u) - 1)
            found = np.where(u[at] == own, c[at], 0)
        logs = np.rint(np.log10(found + 1.0) * UNIT).astype(np.int64)
        known, sums = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
        np.add.at(known, doc, times * (found[word] > 0))
        np.add.at(sums, doc, times * logs[word])
        out.append((block, known.tobytes(), sums.tobytes()))
    return pd.DataFrame(out, columns=SUMS.names)


def _folded(rows: pd.DataFrame) -> pd.DataFrame:
    known = np.sum([np.frombuffer(x, np.int64) for x in rows["known"]], axis=0)
    logs = np.sum([np.frombuffer(x, np.int64) for x in rows["logs"]], axis=0)
    return pd.DataFrame({"block": rows["block"].iloc[0], "idx": np.arange(len(known), dtype=np.int32), "known": known, "logs": logs})


def score(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32 of the id as text leaves a remainder other
    than 2 by 7; null ids train. Tokens are the words between ASCII white space, A-Z
    lower-cased, and one end. Null and empty texts have the end only. Repeated rows
    count as often as they occur. Without training documents all counts are zero and
    the model is uniform over its classes. An empty table gives an empty result; other
    columns are not looked at. Very long texts are scored whole, in steps. Scores are
    equal up to rounding however the table is partitioned. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    train = rows.where("not held_out").select("doc_id", "text")
    parts = max(2, docs.rdd.getNumPartitions())
    bits = max(3, math.ceil(math.log2(parts)))
    packed = train.select("text").mapInPandas(_count(bits), "shard long, u binary, c binary, e binary")
    sums = "shard long, n long, v long, u binary, c binary, e binary, in_ending array<long>, of_ending array<long>"
    counts = stored(packed.groupBy("shard").applyInPandas(_sum_shard, sums), "word-counts")
    each = [F.sum(F.col(name)[k]).alias(f"{name}{k}") for name in ("in_ending", "of_ending") for k in range(ENDINGS)]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"), *each).first()
    train_docs = train.count()
    n, v = total.n + train_docs, total.v + (train_docs > 0)
    hot = counts.select("u", "c", "e").mapInPandas(_hot(max(1, n / 2**HOT_BITS)), "u long, c long, e int").toPandas()
    inside = [np.array([total[f"{name}{k}"] or 0 for k in range(ENDINGS)], np.float64) for name in ("in_ending", "of_ending")]
    made = Model(n, v, train_docs, hot["u"].to_numpy(np.int64).view(np.uint64), hot["c"].to_numpy(np.int64), hot["e"].to_numpy(np.int64), *inside)
    model = spark.sparkContext.broadcast(made)
    w = made.initial()
    # Shards and the order inside follow from ids and texts, not from the files that hold them.
    place = F.xxhash64("doc_id", "text")
    shards = train.repartition(min(max(1, math.ceil(n / SHARD)), SHARDS), place).sortWithinPartitions(place, "doc_id", "text").select("text")
    for _ in range(rounds):
        moved = shards.mapInPandas(_train(model, spark.sparkContext.broadcast(w)), "slice int, tokens long, sums binary")
        found = moved.repartition(F.col("slice")).mapInPandas(_averaged, moved.schema).collect()  # the weight table, of fixed size
        for r in found:
            w[r.slice : r.slice + CHUNK] = (np.frombuffer(r.sums, np.float64) / r.tokens).reshape(-1, CLASSES)
    weights = spark.sparkContext.broadcast(w)
    scored = stored(rows.mapInPandas(_score(model, weights, bits), BLOCKS), "scored-blocks")
    asked = scored.where("shard is not null").select("block", "shard", "docs", "u", "word", "doc", "times")
    looked = asked.groupBy("shard").cogroup(counts.select("shard", "u", "c").groupBy("shard")).applyInPandas(_look_up, SUMS)
    back = looked.groupBy("block").applyInPandas(_folded, "block long, idx int, known long, logs long")
    back = back.select("block", "idx", F.col("known").alias("more"), F.col("logs").alias("add"))
    whole = scored.where("shard is null").join(back, ["block", "idx"], "left")
    logs = (F.col("logs") + F.coalesce("add", F.lit(0))) / F.lit(UNIT)
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"), (logs + F.col("model")).alias("score"),
    )
