"""Quality classifier by weak supervision.

Overlapping heuristic labellers vote junk, clean or abstain on every document.
Expectation-maximisation over the counts of all vote patterns estimates how often each
labeller votes what on junk and on clean documents, without any given label. The
posteriors of the patterns then label a sample on which a linear scorer over hashed
features is trained; the scorer judges all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.common import named_back, renamed, small_batches, stored
from chronomart.llm.shingles import mixed, word_hashes

#: Documents on which the linear scorer is trained. The counts behind the labels cover all documents.
SAMPLE = 20_000
WIDTH = 1 << 12
#: Below so many words most labellers abstain.
SHORT = 12

#: Fixed classes of UTF-8 bytes: space, lower, upper, digit, sentence mark, other symbol, beyond ASCII.
SPACE, LOWER, UPPER, DIGIT, MARK, SYMBOL, WIDE = range(7)
_CLASS = np.full(256, SYMBOL, np.uint8)
_CLASS[list(b" \t\n\x0b\x0c\r")] = SPACE
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = LOWER, UPPER, DIGIT, WIDE
_CLASS[list(b".,;:!?'-()\"")] = MARK

#: Labeller: measure, side of a value at which it votes junk, that value, and the value from which on it votes clean.
LABELLERS = {
    "shouting": ("upper", ">", 0.55, None),
    "symbols": ("symbol", ">", 0.10, None),
    "separators": ("bare", ">", 0.10, None),
    "lists": ("listed", ">", 0.15, None),
    "few words": ("distinct", "<", 0.22, None),
    "stutter": ("stutter", ">", 0.15, None),
    "loops": ("looped", ">", 0.50, None),
    "marks": ("doubled", ">", 0.20, None),
    "long words": ("length", ">", 13.0, None),
    "sentences": ("sentences", "<", 0.006, 0.02),
    "short words": ("brief", "<", 0.08, 0.15),
}
MEASURES = tuple(dict.fromkeys(labeller[0] for labeller in LABELLERS.values()))


def measures(text: str | None) -> tuple[dict[str, float], np.ndarray, int]:
    """Measures of the whole text, the share of words by the classes they hold, and the number of words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    kind = _CLASS[np.frombuffer(data, np.uint8)]
    inside = kind != SPACE
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(starts)
    if not n:
        return dict.fromkeys(MEASURES, 0.0), np.zeros(128), 0
    count = np.bincount(kind, minlength=7)
    solid = len(data) - count[SPACE]
    letters = max(1, count[LOWER] + count[UPPER] + count[WIDE])
    shape = np.bitwise_or.reduceat(np.where(inside, 1 << kind, 0).astype(np.uint8), starts)
    shares = np.bincount(shape >> 1, minlength=128)[:128] / n
    last = kind[ends - 1]
    before = kind[np.maximum(ends - 2, 0)]
    words = word_hashes(text)
    loops = mixed(words[2:] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[:-2]) if n > 2 else words[:0]
    bare = ~((shape & ((1 << LOWER) | (1 << UPPER) | (1 << DIGIT) | (1 << WIDE))) > 0)
    tail = np.isin(last, (MARK, SYMBOL)) & np.isin(before, (MARK, SYMBOL)) & (ends - starts > 2)
    lengths = ends - starts
    real = ~bare if not bare.all() else bare
    stutter = (words[1:] == words[:-1]).mean() if n > 1 else 0.0
    return {
        "upper": count[UPPER] / letters,
        "symbol": count[SYMBOL] / solid,
        "bare": bare.mean(),
        "listed": (bare[1:] & ~bare[:-1]).mean() if n > 1 else 0.0,
        "distinct": len(np.unique(words)) / n * max(1.0, np.log1p(n) / 6),
        "stutter": stutter,
        "looped": 1 - len(np.unique(loops)) / len(loops) if len(loops) else 0.0,
        "doubled": tail.mean(),
        "length": lengths[real].mean(),
        "sentences": (np.isin(np.frombuffer(data, np.uint8)[ends - 1], list(b".!?")) & ~tail)[real].mean() * (1 - stutter) ** 2,
        "brief": (lengths <= 3)[real].mean() * (1 - stutter) ** 2,
    }, shares, n


def votes(found: dict[str, float], n: int) -> str:
    """One character per labeller: 1 junk, 0 clean, - abstains."""
    out = []
    for measure, side, junk, clean in LABELLERS.values():
        sign = 1 if side == ">" else -1
        x = sign * found[measure]
        if n < SHORT:
            out.append("-")
        elif x >= sign * junk:
            out.append("1")
        else:
            out.append("0" if clean is not None and x <= sign * clean else "-")
    return "".join(out)


def hashed(found: dict[str, float], shares: np.ndarray, n: int) -> dict[int, float]:
    """Bins of the linear scorer and their values."""
    out: dict[int, float] = {}

    def add(name: str, value: float) -> None:
        at = crc32(name.encode()) % WIDTH
        out[at] = out.get(at, 0.0) + value

    add("all", 1.0)
    for name, x in found.items():
        for step in np.linspace(0, 1, 11) if name != "length" else range(2, 16):
            if x > step:
                add(f"{name}>{step:.1f}", 0.5)
    for k in np.flatnonzero(shares):
        add(f"shape {k}", float(shares[k]))
    add(f"words {min(8, int(np.log2(n + 1)))}", 0.3)
    return out


def em(patterns: dict[str, int], rounds: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """(share of junk, accuracy of each labeller, posterior junk of each pattern).

    A labeller's accuracy is how often its vote, when it has one, is right; given the
    class, labellers are taken as independent and an abstention says nothing. Starts
    from the majority vote; a pattern of abstentions keeps the prior. Accuracies stay
    between a coin and certainty, so that no labeller is turned around or decides alone.
    """
    keys = sorted(patterns)
    if not keys:
        return 0.0, np.zeros(len(LABELLERS)), {}
    weight = np.array([patterns[k] for k in keys], np.float64)
    vote = np.array([["0-1".index(c) - 1 for c in k] for k in keys])
    junk = np.where((vote != 0).any(1), 1 / (1 + np.exp(-vote.sum(1) * 1.5)), 0.2)
    for _ in range(rounds):
        prior = np.clip((junk * weight).sum() / weight.sum(), 0.01, 0.5)
        right = np.where(vote > 0, junk[:, None], 1 - junk[:, None]) * (vote != 0)
        accuracy = ((right * weight[:, None]).sum(0) + 8) / (((vote != 0) * weight[:, None]).sum(0) + 10)
        accuracy = np.clip(accuracy, 0.55, 0.98)
        log = np.log(prior / (1 - prior)) + vote @ np.log(accuracy / (1 - accuracy))
        new = 1 / (1 + np.exp(-log))
        if np.abs(new - junk).max() < 1e-7:
            break
        junk = new
    return float(prior), accuracy, dict(zip(keys, junk.tolist()))


def fit(rows: list[dict[int, float]], target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic regression on soft labels, by gradient descent with momentum."""
    used = sorted({k for r in rows for k in r})
    at = {k: i for i, k in enumerate(used)}
    x = np.zeros((len(rows), len(used)), np.float32)
    for i, r in enumerate(rows):
        for k, v in r.items():
            x[i, at[k]] = v
    w, speed = np.zeros(len(used), np.float32), np.zeros(len(used), np.float32)
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed - (x.T @ (p - target.astype(np.float32)) / len(rows) + 1e-4 * w)
        w = w + 0.5 * speed
    out = np.zeros(WIDTH)
    out[used] = w
    return out


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [votes(found, n) for found, _, n in map(measures, batch["text"])]
        yield pd.DataFrame({"at": batch["at"].to_numpy(), "pattern": rows})


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found, shares, n = measures(text)
            h = hashed(found, shares, n)
            rows.append((votes(found, n), list(h), list(h.values())))
        yield pd.DataFrame(rows, columns=["pattern", "bins", "values"])


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", seed: int = 3):
    """(weights of the scorer, share of junk, accuracies of the labellers)."""
    texts = docs.select(F.xxhash64(F.lit(seed), F.col(id_col)).alias("at"), F.col(text_col).alias("text"))
    with small_batches(docs.sparkSession):
        voted = stored(texts.mapInPandas(_vote, "at long, pattern string"), "votes")
    counts = {r.pattern: r["count"] for r in voted.groupBy("pattern").count().collect()}  # at most 3 ** labellers rows
    prior, table, junk = em(counts)
    n = sum(counts.values())
    limit = -(2**63) + int(2**64 * min(1.0, sample / n)) - 1 if n else 0
    chosen = texts.where(F.col("at") <= limit).mapInPandas(_featured, "pattern string, bins array<int>, values array<double>")
    with small_batches(docs.sparkSession):
        rows = chosen.orderBy(F.xxhash64("bins", "values")).limit(2 * sample).collect()
    return fit([dict(zip(r.bins, r["values"])) for r in rows], np.array([junk[r.pattern] for r in rows])), prior, table


def judged(docs: DataFrame, weights: np.ndarray, text_col: str = "text", column: str = "junk") -> DataFrame:
    """``docs`` with the scorer's probability of junk."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    # Texts are judged one by one. Spark sends them to a plain function by the hundred, whatever the settings of the caller.
    @F.udf("double", useArrow=False)
    def junk(text: str | None) -> float:
        w = shared.value
        z = sum(w[k] * v for k, v in hashed(*measures(text)).items())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return docs.withColumn(column, junk(F.col(text_col)))


def classify(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, junk (probability), kept.

    A document is rejected when junk is above ``threshold``. Null and empty texts, and
    texts too short for the labellers, are judged by the scorer like all others; equal
    texts get equal values, whatever their ids. The sample is chosen by hash of the
    id. An empty table gives an empty result; other columns are not looked at.
    """
    weights, _, _ = train(docs, sample, id_col, text_col)
    out = judged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")), weights, "__text")
    return out.select("doc_id", "junk", (F.col("junk") <= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that the scorer doesn't reject, with their columns, whatever their names.

    Nulls, ties, repeated rows, empty tables and texts of any length are as in ``classify``.
    """
    weights, _, _ = train(docs, id_col=id_col, text_col=text_col, **parameters)
    rows, names = renamed(docs)
    return judged(rows, weights, names[text_col], "__junk").where(F.col("__junk") <= threshold).select(*named_back(names))
