"""Token ids in binary files by a static range asymmetric numeral system (rANS).

Documents are tokenised in ascending id order and cut into segments of whole
documents. A segment has one frequency table, shared by its blocks. A block interleaves
``LANES`` independent coders: token t goes to lane t mod ``LANES``. The header of a
block is its checkpoint: where its tokens start, the state and the length of every
lane, and the checksum of its ids. So any block can be decoded alone, given the table
of its segment.

The files are Parquet, written by Spark's committer, so a retried task leaves no
partial file: one row per block, and one per segment with the table and the list of
its documents.
"""

from __future__ import annotations

import json
import os
import string
import struct
from collections.abc import Iterator
from functools import lru_cache
from operator import add
from unicodedata import normalize
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.sources.scratch import new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Fixed value: the id that ends a document.
END = 1
LANES, STEPS = 32, 512
BLOCK = LANES * STEPS
#: A segment ends with the document that brings it to so many tokens.
SEGMENT = 1 << 20
#: Frequencies add up to 2 ** SCALE; states stay in [2 ** 31, 2 ** 63) and move by 32 bits.
SCALE = 20
LOW = np.uint64(1 << 31)
#: After so many new words a worker forgets those that it has not met since as many before.
REMEMBERED = 300_000
#: Texts whose words are numbered together.
ROWS_AT_ONCE = 1024
#: Words of letters that go to the library as one text.
JOINED = 512
#: A run of these after letters is a pre-token of its own.
STOPS = ".,!?;:&$#*%"

FILES = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("data", T.BinaryType()),
])
ROWS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
    T.StructField("inside", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


def only_letters(word: str) -> bool:
    """Whether a word is letters, also once composed and lower-cased as the file asks: some letters become letter and mark."""
    return word.isalpha() and (word.isascii() or normalize("NFC", word).lower().isalpha())


class AsciiWords:
    """Ids of words of ASCII letters by tiktoken, several times faster than the library: such words need no normalising
    but lower case. A word's last letter is written as a capital in place of the file's suffix, so one pattern cuts joined
    words. Ranks are the file's merges; a test compares both libraries over words of the corpus and random ones.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        def written(token: str) -> bytes:
            core = token.removesuffix(suffix)
            if not (core.isascii() and core.isalpha() and core.islower()):
                return b""
            return (core[:-1] + core[-1].upper() if token != core else core).encode()

        letters = [*string.ascii_lowercase, *(x + suffix for x in string.ascii_lowercase)]
        tokens = [t for t in dict.fromkeys([*letters, *(a + b for a, b in merges)]) if written(t)]
        ranks = {written(t): k for k, t in enumerate(tokens)}
        if len(ranks) != len(tokens) or any(t not in vocabulary for t in tokens):
            raise ValueError("the file has no plain rank for its ASCII tokens")
        self.ids = np.array([vocabulary[t] for t in tokens], np.uint32)
        self.last = np.array([t.endswith(suffix) for t in tokens])
        self.encoding = tiktoken.Encoding("ascii-words", pat_str="[a-z]*[A-Z]", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as bytes; ``words`` are not empty."""
        if not words:
            return []
        chars = np.frombuffer(b"".join(words).lower(), np.uint8).copy()
        chars[np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) - 1] -= 32
        found = self.encoding.encode_to_numpy(chars.tobytes().decode("ascii"))
        ends = (4 * (np.flatnonzero(self.last[found]) + 1)).tolist()
        data = self.ids[found].tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


class Words:
    """Ids of whole texts as by the tokenizers library, each word of a batch once; new ones go to it together.

    The file's pre-tokens never hold white space, so words between ASCII white space can
    be encoded on their own, and so can a stop after letters. The last id of a pre-token
    shows as such, so words of letters, one pre-token each, can share a text. A text
    with a special token in it is encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # Spark runs one task a core; the library's own threads would contend for them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        self.ascii = AsciiWords(vocabulary, [m.split(" ") if isinstance(m, str) else m for m in merges], suffix)
        #: Words met lately, and those met before them.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of letters. Where some word is more than one pre-token, its group is encoded word by word."""
        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        out = []
        for group, ids in zip(groups, self._ids([b" ".join(g).decode() for g in groups])):
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(group):
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += [i.tobytes() for i in self._ids([w.decode() for w in group])]
        return out

    def _learn(self, new: set[bytes]) -> None:
        known = self.known
        # ``isalpha`` of bytes is true for ASCII letters only: most words are told by one call.
        plain = {w for w in new if w.isalpha()}
        letters: set[bytes] = set()
        rest = new - plain
        stops = STOPS.encode()
        # Plain lists of bytes: tuples by the hundred thousand would keep the garbage collector busy.
        stopped = [w for w in rest if w.rstrip(stops).isalpha()]
        others = rest.difference(stopped)
        for data in list(others):
            word = data.decode()
            if only_letters(word):
                letters.add(data)
                others.remove(data)
            elif only_letters(word.rstrip(STOPS)):
                stopped.append(data)
                others.remove(data)
        cores = [w.rstrip(stops) for w in stopped]
        tails = [w[len(core) :] for w, core in zip(stopped, cores)]
        both = set(cores).difference(known)
        plain.update([w for w in both if w.isalpha()])
        letters.update(both - plain)
        others.update(tails)
        ascii_words, words, odd = list(plain), list(letters), list(others)
        known.update(zip(ascii_words, self.ascii.encode(ascii_words)))
        known.update(zip(words, self._letters(words)))
        known.update(zip(odd, [i.tobytes() for i in self._ids([w.decode() for w in odd])]))
        known.update(zip(stopped, map(add, map(known.__getitem__, cores), map(known.__getitem__, tails))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        whole = [b"<|" in d and any(s in d for s in self.special) for d in data]
        # Arrow splits and numbers the words, so only the distinct ones of a batch become Python objects.
        split = pc.ascii_split_whitespace(pa.array([b"" if w else d for d, w in zip(data, whole)], pa.large_binary()).view(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.view(pa.large_binary()).to_pylist()
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        known[b""] = b""  # what stands before or after white space at the edge of a text
        new = set(words).difference(known)
        again = new.intersection(older)
        known.update((w, older[w]) for w in again)
        self._learn(new - again)
        found = list(map(known.__getitem__, words))
        ids = np.frombuffer(b"".join(found), np.uint32)
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(length) - length
        word = coded.indices.to_numpy()
        n = length[word]
        ends = np.append(0, np.cumsum(n))
        flat = ids[np.repeat(first[word] - ends[:-1], n) + np.arange(ends[-1])]
        cuts = ends[split.offsets.to_numpy()].tolist()
        end = np.uint32(END)
        return [np.append(self._ids([t])[0] if w else flat[a:b], end) for t, w, a, b in zip(texts, whole, cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _words(path: str) -> Words:
    return Words(path)


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2 ** SCALE, at least 1 for every symbol that occurs."""
    used = np.flatnonzero(counts)
    total = 1 << SCALE
    if len(used) > total:
        raise ValueError("more symbols than slots")
    share = counts[used] / counts[used].sum() * (total - len(used))
    freq = np.floor(share).astype(np.int64)
    rest = total - len(used) - freq.sum()
    freq[np.argsort(freq - share, kind="stable")[:rest]] += 1
    out = np.zeros(len(counts), np.int64)
    out[used] = freq + 1
    return out


def table_bytes(freq: np.ndarray) -> bytes:
    used = np.flatnonzero(freq)
    return struct.pack("<I", len(used)) + used.astype("<u4").tobytes() + freq[used].astype("<u4").tobytes()


def table_from(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return np.frombuffer(data, "<u4", n, at + 4), np.frombuffer(data, "<u4", n, at + 4 + 4 * n), at + 4 + 8 * n


def encode_blocks(ids: np.ndarray) -> tuple[bytes, list[bytes]]:
    """(table, blocks) of a segment: all lanes of all blocks move together, last token first."""
    freq = quantised(np.bincount(ids))
    start = np.cumsum(freq) - freq
    blocks = -(-len(ids) // BLOCK)
    lanes = blocks * LANES
    padded = np.full(blocks * BLOCK, -1, np.int64)
    padded[: len(ids)] = ids
    grid = padded.reshape(blocks, STEPS, LANES).transpose(1, 0, 2).reshape(STEPS, lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, used = np.zeros((lanes, STEPS), np.uint32), np.zeros(lanes, np.int64)
    f64, s64 = freq.astype(np.uint64), start.astype(np.uint64)
    limit = np.uint64(63 - SCALE)
    for t in range(STEPS - 1, -1, -1):
        row = grid[t]
        live = np.flatnonzero(row >= 0)
        f, x = f64[row[live]], state[live]
        spill = (x >> limit) >= f
        at = live[spill]
        words[at, used[at]] = (x[spill] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        used[at] += 1
        x = np.where(spill, x >> np.uint64(32), x)
        q = x // f
        state[live] = (q << np.uint64(SCALE)) + (x - q * f) + s64[row[live]]
    out = []
    for b in range(blocks):
        part = slice(b * LANES, (b + 1) * LANES)
        own = ids[b * BLOCK : (b + 1) * BLOCK]
        head = struct.pack("<QII", b * BLOCK, len(own), crc32(own.astype("<u4").tobytes()))
        body = b"".join(words[k, : used[k]][::-1].astype("<u4").tobytes() for k in range(part.start, part.stop))
        out.append(head + state[part].astype("<u8").tobytes() + used[part].astype("<u2").tobytes() + body)
    return table_bytes(freq), out


def decode_blocks(symbols: np.ndarray, freq: np.ndarray, blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of blocks of one segment, each checked against its checksum."""
    f64 = freq.astype(np.uint64)
    s64 = np.cumsum(f64, dtype=np.uint64) - f64
    slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    heads = [struct.unpack_from("<QII", b) for b in blocks]
    state = np.concatenate([np.frombuffer(b, "<u8", LANES, 16) for b in blocks]).astype(np.uint64)
    used = np.concatenate([np.frombuffer(b, "<u2", LANES, 16 + 8 * LANES) for b in blocks]).astype(np.int64)
    words = np.append(np.concatenate([np.frombuffer(b, "<u4", offset=16 + 10 * LANES) for b in blocks]), np.uint32(0)).astype(np.uint64)
    at = np.cumsum(used) - used
    n = np.array([h[1] for h in heads])
    lane = np.tile(np.arange(LANES), len(blocks))
    length = np.repeat(n, LANES)
    out = np.zeros((STEPS, len(state)), np.int64)
    mask = np.uint64((1 << SCALE) - 1)
    for t in range(STEPS):
        live = np.flatnonzero(t * LANES + lane < length)
        x = state[live]
        low = x & mask
        s = slot[low]
        out[t, live] = s
        x = f64[s] * (x >> np.uint64(SCALE)) + low - s64[s]
        more = x < LOW
        x[more] = (x[more] << np.uint64(32)) | words[at[live[more]]]
        at[live[more]] += 1
        state[live] = x
    ids = symbols[out].reshape(STEPS, len(blocks), LANES).transpose(1, 0, 2).reshape(len(blocks), BLOCK)
    found = [ids[k, : n[k]].astype("<u4") for k in range(len(blocks))]
    for k, (head, own) in enumerate(zip(heads, found)):
        if crc32(own.tobytes()) != head[2]:
            raise ValueError(f"checksum of the block at token {head[0]} differs")
    return found


def _write(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part = _words(path), TaskContext.get().partitionId()
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held = segment = 0

        def flush() -> pd.DataFrame:
            flat = np.concatenate(ids)
            table, blocks = encode_blocks(flat)
            lengths = np.array([len(i) for i in ids], "<i8")
            named = np.array([-1 if d is None else d for d in docs], "<i8")
            null = np.array([d is None for d in docs], np.uint8)
            head = struct.pack("<Q", len(docs)) + named.tobytes() + lengths.tobytes() + null.tobytes() + table
            return pd.DataFrame({
                "part": part, "segment": segment, "block": [-1, *range(len(blocks))],
                "n_tokens": [len(flat)] + [len(flat[k * BLOCK : (k + 1) * BLOCK]) for k in range(len(blocks))],
                "data": [head, *blocks],
            })

        for batch in batches:
            for k in range(0, len(batch), ROWS_AT_ONCE):
                rows = batch.iloc[k : k + ROWS_AT_ONCE]
                found = words.encode(["" if t is None else t for t in rows["text"]])
                for doc, own in zip(rows["doc_id"], found):
                    docs.append(None if pd.isna(doc) else int(doc))
                    ids.append(own)
                    held += len(own)
                    if held >= SEGMENT:
                        yield flush()
                        docs, ids, held, segment = [], [], 0, segment + 1
        if docs:
            yield flush()

    return run


def write_ids(docs: DataFrame, folder: str, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all ``docs`` in ascending order of (id, text) as files below ``folder``.

    Null ids come first; null and empty texts have the end id only; repeated rows are
    written one by one; an empty table writes no block. Texts are encoded whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInPandas(_write(path), FILES).write.option("compression", "none").parquet(folder)


def _read(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    head = rows["data"].iloc[0]
    (n,) = struct.unpack_from("<Q", head)
    docs, lengths = np.frombuffer(head, "<i8", n, 8), np.frombuffer(head, "<i8", n, 8 + 8 * n)
    null = np.frombuffer(head, np.uint8, n, 8 + 16 * n).astype(bool)
    symbols, freq, _ = table_from(head, 8 + 17 * n)
    flat = np.concatenate(decode_blocks(symbols, freq, list(rows["data"].iloc[1:])))
    ends = np.cumsum(lengths)
    view = memoryview(flat.tobytes())
    crcs = [crc32(view[4 * (e - m) : 4 * e]) for e, m in zip(ends.tolist(), lengths.tolist())]
    return pd.DataFrame({
        "doc_id": pd.array(docs, "Int64"), "part": rows["part"].iloc[0], "segment": rows["segment"].iloc[0],
        "inside": ends - lengths, "n_tokens": lengths, "ids_crc32": crcs,
    }).assign(doc_id=lambda d: d["doc_id"].mask(null))


def read_ids(spark, folder: str) -> DataFrame:
    """One row per document from the files alone: doc_id, start, n_tokens, ids_crc32.

    Segments are decoded independently. Their places follow from the token counts in
    the block headers; only one total per written partition passes through the driver.
    """
    files = spark.read.schema(FILES).parquet(folder)
    heads = files.where("block = -1").select("part", "segment", "n_tokens")
    totals = sorted((r.part, r.n) for r in heads.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    sofar, places = 0, []
    for part, n in totals:
        places.append((part, sofar))
        sofar += n
    first = spark.createDataFrame(places, "part int, first long")
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = heads.withColumn("before", before).join(first, "part").select("part", "segment", (F.col("first") + F.col("before")).alias("at"))
    rows = files.groupBy("part", "segment").applyInPandas(_read, ROWS)
    return rows.join(offsets, ["part", "segment"]).select("doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str = TOKENIZER, folder: str | None = None, **columns: str) -> DataFrame:
    """Writes the files and returns what ``read_ids`` finds in them."""
    folder = folder or new_path(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path, **columns)
    return read_ids(docs.sparkSession, folder)
