"""Byte-level BPE with a minimal acyclic transducer for frequent words.

The most frequent pre-tokens of the corpus and their ids are compiled into a minimal
acyclic automaton: states with equal futures are shared, and the numbers of words
below each state turn a path into the rank of its word, under which the ids stand. The
automaton is written as one file in the shared folder and memory-mapped by the tasks.
Words outside it are merged exactly, in numpy for all new words of a batch at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.common import small_batches, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Words compiled into the lexicon, at most: about 2 MB.
LEXICON = 40_000
#: After so many new words a worker forgets those that it has not met since as many before.
REMEMBERED = 300_000
#: Words are merged in matrices of these widths and so many cells; longer ones one by one with a heap.
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128, 256)
CELLS = 1 << 20
#: The rank of a pair without merge.
NEVER = np.iinfo(np.int32).max
#: Texts encoded at once.
STEP = 512
MAGIC = b"MATL"

_PRETOKENS = regex.compile(public_tokenizers.PATTERN)
#: A space after a visible character always starts a pre-token.
_CUT = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, bytes and merge ranks of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = data["model"]["vocab"]
        self.bytes = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes[i] = token.encode() if token in self.special else bytes(symbols[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i).encode() for i in range(len(self.bytes))]
        by_bytes = {b: i for i, b in enumerate(self.bytes) if b}
        self.single = np.array([by_bytes[bytes([b])] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in reversed(list(enumerate(pairs)))}
        keys = np.array([a << 20 | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        found = np.array(list(self.rank.values()), np.int64).reshape(-1, 2)
        #: Pairs in ascending order with the rank of their merge, and what each rank makes.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(found[order, 0], NEVER).astype(np.int32)
        self.made = np.zeros(len(pairs) + 1, np.int32)
        self.made[found[:, 0]] = found[:, 1]
        symbol = self.single.astype(np.int64)
        self.of_bytes = self.rank_of(np.repeat(symbol, 256), np.tile(symbol, 256)).reshape(256, 256)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None

    def merge_long(self, word: bytes) -> list[int]:
        """The merges of one word, lowest rank first, leftmost first, with a heap."""
        ids = [int(self.single[b]) for b in word]
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (ids[i], ids[j]) in self.rank:
                heapq.heappush(heap, (self.rank[ids[i], ids[j]][0], i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.rank[a, b][1], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [i for i in ids if i >= 0]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the merges of pairs of ids, NEVER where there is none."""
        pair = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, self.ranks[at], NEVER)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        return [np.frombuffer(ids, np.int32) for ids in self.merge_packed(words)]

    def merge_packed(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each. Words of like lengths are merged together, in rows of one matrix."""
        out = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        low = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            step = max(1, CELLS // width)
            for at in range(0, len(chosen), step):
                rows = chosen[at : at + step]
                for k, ids in zip(rows.tolist(), self._merge_rows([words[k] for k in rows.tolist()], sizes[rows], width)):
                    out[k] = ids
            low = width
        for k in np.flatnonzero(sizes > low).tolist():
            out[k] = np.array(self.merge_long(words[k]), np.int32).tobytes()
        return out

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray, width: int) -> list[bytes]:
        """In every round each row makes its merge of lowest rank, leftmost first.

        A merge leaves its id in its first cell and closes its second; only the two pairs
        around it get new ranks.
        """
        cells = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column < sizes[:, None], self.single[cells], -1)
        rank = np.full(cells.shape, NEVER, np.int32)
        rank[:, :-1] = np.where(column[1:] < sizes[:, None], self.of_bytes[cells[:, :-1], cells[:, 1:]], NEVER)
        ids, flat = ids.ravel(), rank.ravel()
        # Columns of the open cells around each; the length of the word after its last.
        after = np.minimum(column + 1, sizes[:, None]).astype(np.int32).ravel()
        before = np.tile(column - 1, len(words)).astype(np.int32)
        live = np.arange(len(words))
        while len(live):
            at = (rank if len(live) == len(words) else rank[live]).argmin(axis=1)
            spot = live * width + at
            lowest = flat[spot]
            going = lowest < NEVER
            live, at, spot, lowest = live[going], at[going], spot[going], lowest[going]
            base, end = live * width, sizes[live]
            gone = base + after[spot]
            ids[spot], ids[gone], flat[gone] = self.made[lowest], -1, NEVER
            follower = after[gone]
            after[spot] = follower
            inner = follower < end
            flat[spot] = NEVER
            here, there = spot[inner], (base + follower)[inner]
            before[there] = at[inner]
            flat[here] = self.rank_of(ids[here], ids[there])
            lead = before[spot]
            inner = lead >= 0
            here, there = (base + lead)[inner], spot[inner]
            flat[here] = self.rank_of(ids[here], ids[there])
        open_ = ids >= 0
        data, ends = ids[open_].astype(np.int32).tobytes(), 4 * np.cumsum(open_.reshape(-1, width).sum(axis=1))
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


class Lexicon:
    """A minimal acyclic transducer read from memory.

    An arc is found by its key, state * 256 + byte, in the ascending keys of all arcs;
    it gives the next state and the number of words that branch off before it.
    """

    def __init__(self, data) -> None:
        magic, states, arcs, words, ids = struct.unpack_from("<4sIIII", data, 0)
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        at = 20

        def take(kind, n):
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        self.arc, self.target, self.before = take(np.uint32, arcs), take(np.uint32, arcs), take(np.uint32, arcs)
        self.start, self.ids = take(np.uint32, words + 1), take(np.int32, ids)
        self.final = take(np.uint8, states)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word among the words of the lexicon, -1 for others. All words take a step together."""
        found = np.full(len(words), -1, np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        live, at = np.arange(len(words)), np.cumsum(sizes) - sizes
        state, rank, end = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), at + sizes
        while len(live):
            done = at == end
            ended = done & (self.final[state] > 0) if len(self.final) else done & False
            found[live[ended]] = rank[ended]
            live, at, end, state, rank = (x[~done] for x in (live, at, end, state, rank))
            key = state << 8 | data[at]
            arc = np.searchsorted(self.arc, key)
            hit = np.flatnonzero(arc < len(self.arc))
            hit = hit[self.arc[arc[hit]] == key[hit]]
            arc = arc[hit]
            live, at, end, state, rank = live[hit], at[hit] + 1, end[hit], self.target[arc].astype(np.int64), rank[hit] + self.before[arc]
        return found

    def output(self, rank: int) -> np.ndarray:
        return self.ids[self.start[rank] : self.start[rank + 1]]

    def get(self, word: bytes) -> np.ndarray | None:
        rank = int(self.find([word])[0])
        return None if rank < 0 else self.output(rank)


def compiled(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The transducer of distinct ``words`` as bytes. Sorted words are added one by one; a state that no later
    word can reach is replaced by an equal one if there is one."""
    order = sorted(range(len(words)), key=lambda k: words[k])
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]
    last = b""

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    for k in order:
        word = words[k]
        shared = len(os.path.commonprefix([last, word]))
        freeze(shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    freeze(0)
    frozen.append((path[0][0], tuple(path[0][1])))
    total = len(frozen)
    place = lambda s: total - 1 - s  # noqa: E731  the root comes first
    below = [0] * total
    for s, (final, arcs) in enumerate(frozen):
        below[s] = int(final) + sum(below[t] for _, t in arcs)
    arc, target, before, final_flags = [], [], [], bytearray()
    for s in range(total - 1, -1, -1):
        final, arcs = frozen[s]
        sofar = int(final)
        for byte, t in arcs:
            arc.append(place(s) << 8 | byte)
            target.append(place(t))
            before.append(sofar)
            sofar += below[t]
        final_flags.append(final)
    outputs = [np.asarray(ids[k], np.int32) for k in order]
    start = np.cumsum([0, *map(len, outputs)]).astype(np.uint32)
    flat = np.concatenate(outputs) if outputs else np.zeros(0, np.int32)
    head = struct.pack("<4sIIII", MAGIC, total, len(target), len(words), len(flat))
    arrays = (np.array(arc, np.uint32), np.array(target, np.uint32), np.array(before, np.uint32), start, flat)
    return head + b"".join(a.tobytes() for a in arrays) + bytes(final_flags)


def chunks(text: str) -> list[str]:
    """Pieces of a text that start at pre-token boundaries, so that each can be encoded on its own.

    A cut stands before a space that follows a visible character. A piece may hold
    several pre-tokens.
    """
    if _ODD.search(text):
        return _CUT.split(text)
    head, *rest = text.split(" ")
    return ([head] if head else []) + [" " + x for x in rest]


def pretokens(chunk: str) -> Sequence[str]:
    """The pre-tokens of a chunk. The commonest shapes, a space and letters with or without a stop, need no pattern."""
    if chunk[:1] == " ":
        if chunk[1:].isalpha():
            return (chunk,)
        if chunk[-1] in ".," and chunk[1:-1].isalpha():
            return chunk[:-1], chunk[-1]
    return _PRETOKENS.findall(chunk)


class Codec:
    """Encodes and decodes texts; remembers the words of a worker."""

    def __init__(self, path: str, lexicon: Lexicon | None = None) -> None:
        self.vocabulary, self.lexicon = _vocabulary(path), lexicon
        #: Words met lately, and those met before them.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, new: Iterable[str]) -> None:
        known = self.known
        compound = [(c, found) for c in new if len(found := pretokens(c)) != 1]
        pieces = set(new).difference([c for c, _ in compound]).union(*[found for _, found in compound]).difference(known)
        words = {p.encode("utf-8", "surrogatepass"): p for p in pieces}
        if self.lexicon is not None:
            ranks = zip(list(words), self.lexicon.find(list(words)).tolist())
            known.update((words.pop(w), self.lexicon.output(r).tobytes()) for w, r in ranks if r >= 0)
        known.update(zip(words.values(), self.vocabulary.merge_packed(list(words))))
        known.update((c, b"".join([known[p] for p in found])) for c, found in compound)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text. Special tokens in a text are recognised, as the file asks for."""
        special = self.vocabulary.special
        split: list[list] = []
        for text in texts:
            if special and "<|" in text:
                parts = self.vocabulary.split.split(text)
                split.append([p if p in special else chunks(p) for p in parts if p])
            else:
                split.append([chunks(text)])
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*[p for parts in split for p in parts if isinstance(p, list)]).difference(known)
        again = new.intersection(older)
        known.update((c, older[c]) for c in again)
        self._learn(new - again)
        out = []
        for parts in split:
            data = [special[p].to_bytes(4, "little") if isinstance(p, str) else b"".join([known[c] for c in p]) for p in parts]
            out.append(np.frombuffer(b"".join(data), np.int32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        table = self.vocabulary.bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _codec(path: str, lexicon_file: str | None) -> Codec:
    """One codec per worker process and lexicon; the file is mapped, not read."""
    lexicon = None
    if lexicon_file:
        with open(lexicon_file, "rb") as f:
            lexicon = Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    return Codec(path, lexicon)


def frequent(docs: DataFrame, text_col: str = "text", words: int = LEXICON) -> list[str]:
    """The most frequent pre-tokens that start with a space, over all documents; ties by code point."""
    pieces = docs.select(F.explode(F.split(F.col(text_col), " ")).alias("w")).groupBy("w").count()
    top = pieces.where(F.rlike("w", F.lit(r"^\p{L}+$")) & (F.length("w") <= 64)).orderBy(F.desc("count"), "w").limit(words)
    return [" " + r.w for r in top.collect()]


def lexicon_of(docs: DataFrame, path: str, text_col: str = "text", words: int = LEXICON) -> str:
    """Compiles the lexicon of ``docs`` and gives every executor a copy of the file; returns its name there."""
    chosen = [w.encode() for w in frequent(docs, text_col, words)]
    name = f"lexicon-{uuid.uuid4().hex}.matl"
    file = os.path.join(tempfile.mkdtemp(), name)
    with open(file, "wb") as f:
        f.write(compiled(chosen, _vocabulary(path).merge(chosen)))
    docs.sparkSession.sparkContext.addFile(file)
    return name


def _mapped(path: str, lexicon: str, parts):
    """A function for mapInPandas that adds to each batch what ``parts`` makes of (codec, texts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, SparkFiles.get(lexicon))
        for batch in batches:
            for k in range(0, len(batch), STEP):
                rows = batch.iloc[k : k + STEP]
                texts = ["" if t is None else t for t in rows["text"]]
                made = parts(codec, texts)
                yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").values, **made})

    return run


def _ids(codec: Codec, texts: list[str]) -> dict[str, list]:
    return {"ids": codec.encode(texts)}


def _digests(codec: Codec, texts: list[str]) -> dict[str, list]:
    ids, decimal = codec.encode(texts), codec.vocabulary.decimal
    return {
        "n_tokens": [len(i) for i in ids],
        "ids_sha256": [hashlib.sha256(b",".join([decimal[j] for j in i.tolist()])).hexdigest() for i in ids],
        "decoded_sha256": [hashlib.sha256(codec.decode(i).encode()).hexdigest() for i in ids],
    }


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), equal to what the tokenizer file gives.

    Null and empty texts have no ids; special tokens written in a text become their id.
    Repeated rows are encoded alike; null ids are passed on; an empty table gives an
    empty result; other columns are not looked at. Texts are encoded whole.
    """
    name = lexicon_of(docs, path, text_col)
    return _slim(docs, id_col, text_col).mapInPandas(_mapped(path, name, _ids), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id and the text of ids; bytes that are not UTF-8 become replacement characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, None)
        for batch in batches:
            texts = [None if i is None else codec.decode(np.asarray(i)) for i in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").values, "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256. Cases as in ``encode``."""
    name = lexicon_of(docs, path, text_col)
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    made = _slim(docs, id_col, text_col).mapInPandas(_mapped(path, name, _digests), kinds)
    with small_batches(docs.sparkSession):  # a batch of texts and its ids stay small beside the words of a worker
        return stored(made, "digests")
