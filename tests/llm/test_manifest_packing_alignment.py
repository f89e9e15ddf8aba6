"""The Merkle manifest, packing and alignment against plain versions of themselves, and their odd cases."""

import random
import tracemalloc
from collections import Counter
from hashlib import sha256
from itertools import groupby
from zlib import crc32

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronomart.llm import alignment, merkle, packing, queries
from chronomart.llm.encoders import BYTE_BPE, PIECE_BPE, byte_bpe, piece_bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, part long, block long, n long, idx long, up string"
ODD = ["", None, " \n ", "One", "a b c d", "a b c d", "A b c d", "\x1c nul\x00 é́ 汉字 <|endoftext|>'s <s> ", "x" * 9000, "Word! " * 9000, "a▁b", "ABC" * 5]


@pytest.fixture(scope="module")
def odd(spark):
    clash = ("h", 1, 2, 3, 4, "up")
    rows = [(i, t, "en", None if i % 3 else "s", i, *clash) for i, t in enumerate(ODD)]
    rows += [rows[4], rows[4], (None, "One", None, "lone", None, *clash), (None, "One", "en", "", -5, *clash)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def h(text):
    return sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def climbed(levels, place, digest):
    siblings = ""
    for level in levels[:-1]:
        first = place // 16 * 16
        run = level[first : first + 16]
        siblings += "".join(x for i, x in enumerate(run) if i != place - first)
        digest = h("".join(digest if i == place - first else x for i, x in enumerate(run)))
        place //= 16
    return siblings, digest


def manifest(rows, tampered):
    low = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    leaf = lambda r, text: h("".join(map(framed, (r.doc_id, r.source, r.lang, r.n_chars, text))))
    entries = []
    for r in rows:
        bad = tampered and r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 0
        entries.append((r.source, r.doc_id, leaf(r, r.text), leaf(r, low(r.text)) if bad else leaf(r, r.text)))
    name = lambda e: (e[0] is not None, (e[0] or "").encode())
    entries.sort(key=lambda e: (name(e), e[1] is not None, e[1] or 0, e[2]))
    trees = [list(g) for _, g in groupby(entries, key=name)]
    built = [tree([e[2] for e in t]) for t in trees]
    top = tree([b[-1][0] for b in built])
    out = []
    for k, (own, levels) in enumerate(zip(trees, built)):
        for i, e in enumerate(own):
            below, digest = climbed(levels, i, e[3])
            above, root = climbed(top, k, digest)
            out.append((e[1], e[2], levels[-1][0], top[-1][0], h(below + above), root, root == top[-1][0]))
    return Counter(out)


def found(df, tampered=queries.lower_cased_texts):
    return Counter(tuple(r) for r in merkle.verified(df, tampered).select("id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect())


def test_manifest_matches_a_plain_one(spark, odd, sf):
    assert found(odd) == manifest(odd.collect(), True)
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("s"), F.col("doc_id") % 23)))
    assert found(docs) == manifest(docs.collect(), True)
    rows = found(docs, None)
    assert all(r[-1] for r in rows) and sum(rows.values()) == docs.count()


def test_manifest_of_one_group_of_one_row_of_none(spark, odd, empty, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    whole = docs.withColumn("source", F.lit("one"))
    assert found(whole) == manifest(whole.collect(), True)
    one = odd.where("doc_id = 3")
    assert found(one) == manifest(one.collect(), True) and found(empty) == Counter()


def test_manifest_sql(odd):
    con = duckdb.connect()
    con.register("documents", odd.toArrow())
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(con.sql(queries.OP11_SQL).select(*names).fetchall()) == manifest(odd.collect(), True)


def test_a_changed_link_or_sibling_fails(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    built = merkle.build(docs)
    broken = merkle.Manifest(built.leaves, built.nodes.withColumn("children", F.when((F.col("level") == 1) & (F.col("idx") == 0), F.reverse(F.hex("children")).cast("binary")).otherwise(F.col("children"))), built.tops)
    assert merkle.climb(built).where("not verified").isEmpty()
    assert merkle.climb(broken).where("not verified").count() > 0


# packing ----------------------------------------------------------------------


def check_packing(rows, docs, capacity=2048):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want, got = Counter(), Counter()
    for r in docs:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        at = 0
        for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
            want[r.doc_id, piece, at, stop - at, crc32(np.array(ids[at:stop], "<u4").tobytes())] += 1
            at = stop
    places = {}
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for inside in places.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-sum(r.length for r in rows) // capacity)


def test_packing_places_every_token_once(spark, odd, empty, sf):
    check_packing(packing.pack(odd).collect(), odd.collect())
    assert packing.pack(empty).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(6)
    packed = packing.pack(docs)
    used, least = check_packing(packed.collect(), docs.collect())
    assert packing.fill(packed)[0] == used and packing.fill(packed)[1] >= least and used <= least + 1


def test_gaps_are_closed_by_exchange(spark, sf):
    """Parts of seven pieces can't be packed well alone; together they can."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(4)
    cut = packing.pieces(docs, part_pieces=7)
    alone = cut.select("part", "item", "length", F.col("part").alias("own")).groupBy("own").applyInPandas(packing._packer(2048), packing.PLACED)
    placed = packing.place(cut, part_pieces=1000)
    assert placed.count() == cut.count() == placed.select("part", "item").distinct().count()
    assert placed.select("sequence_id").distinct().count() < alone.select("own", "bin").distinct().count()
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_sequences_hold_the_ids(odd):
    rows = packing.sequences(packing.pack(odd, capacity=64)).collect()
    bpe, texts = byte_bpe(BYTE_BPE), Counter()
    pieces = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) <= 64 and sum(d.length for d in r.documents) == len(ids)
        for d in r.documents:
            if d.doc_id is not None and d.doc_id != 4:
                pieces[d.doc_id, d.piece] = ids[d.offset : d.offset + d.length]
    for doc, text in enumerate(ODD):
        if doc != 4:
            own = np.concatenate([pieces[k] for k in sorted(pieces) if k[0] == doc])
            assert own.tolist() == [*bpe.encode(text or "").tolist(), 0]


def fewest(lengths, capacity):
    """Exact number of bins by search."""
    lengths = sorted(lengths, reverse=True)

    def fits(i, rooms):
        if i == len(lengths):
            return True
        tried = set()
        for k, room in enumerate(rooms):
            if room >= lengths[i] and room not in tried:
                tried.add(room)
                rooms[k] -= lengths[i]
                if fits(i + 1, rooms):
                    return True
                rooms[k] += lengths[i]
        return False

    n = 1
    while not fits(0, [capacity] * n):
        n += 1
    return n


def test_bounds_never_exceed_the_optimum():
    r = random.Random(7)
    met = better = 0
    for _ in range(300):
        capacity = r.choice([10, 12, 30])
        lengths = np.array([r.randint(1, capacity) for _ in range(r.randint(1, 9))])
        bound = packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        bins, offsets, free = packing.best_fit_decreasing(lengths, capacity)
        exact = fewest(lengths.tolist(), capacity)
        assert bound <= exact <= len(free)
        assert [capacity - lengths[bins == b].sum() for b in range(len(free))] == free.tolist()
        met += bound == exact
        better += bound > -(-lengths.sum() // capacity)
    assert met > 270 and better > 30


def test_cuts():
    assert packing.cuts(1) == [0, 1] and packing.cuts(2048) == [0, 2048]
    assert packing.cuts(2049) == [0, 1, 2049] and packing.cuts(6000) == [0, 1904, 3952, 6000]


# encoders ---------------------------------------------------------------------


def test_byte_bpe_gives_the_library_s_ids():
    bpe, r = byte_bpe(BYTE_BPE), random.Random(3)
    library = Tokenizer.from_file(BYTE_BPE)
    library.no_truncation()
    library.no_padding()
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}{chr(c)}.{chr(c)} x" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(r.choices(letters, k=r.randint(1, 60))) for letters in ("ab", "a", " \n", "-=", "<|endoftext|>x", "_-*=.# \n\t\xa0") for _ in range(500)]
    texts += [b"".join(r.choices(bpe.bytes, k=r.randint(1, 8))).decode("utf-8", "ignore") for _ in range(10_000)]
    texts += ["a" * 50_000, " " * 50_000, "<|endoftext|>", "x <|endoftext|>  y", ""]
    for text, encoded in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert bpe.encode(text).tolist() == encoded.ids, text
    library.encode_special_tokens = True
    for text in texts[-4000:]:
        assert bpe.encode_plain(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


# alignment --------------------------------------------------------------------


def aligned(rows):
    """Token by token and byte by byte."""
    a_side = Tokenizer.from_file(BYTE_BPE)
    a_side.no_truncation()
    a_side.no_padding()
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a_bytes, b_bytes = byte_bpe(BYTE_BPE).bytes, piece_bpe(PIECE_BPE).bytes
    per_doc, counts = [], Counter()
    for r in rows:
        groups, links = [], []
        if r.text:
            data = (" " + r.text).encode()
            a, b = a_side.encode(" " + r.text, add_special_tokens=False).ids, b_side.encode(r.text)
            if b"".join(a_bytes[i] for i in a) == data and b"".join(b_bytes[i] for i in b) == data:
                owner = [[], []]
                for side, (ids, table) in enumerate(((a, a_bytes), (b, b_bytes))):
                    for k, i in enumerate(ids):
                        owner[side] += [k] * len(table[i])
                ends = [{p + 1 for p in range(len(data)) if p + 1 == len(data) or o[p] != o[p + 1]} for o in owner]
                at = 0
                for stop in sorted(ends[0] & ends[1]):
                    groups.append(tuple(",".join(str(ids[k]) for k in dict.fromkeys(o[at:stop])) for ids, o in zip((a, b), owner)))
                    at = stop
                links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*owner))]
        counts.update(links)
        text = ";".join("|".join(g) for g in groups)
        sides = [sum(len(g[s].split(",")) for g in groups) for s in (0, 1)]
        per_doc.append((r.doc_id, *sides, len(groups), links, h(text) if groups else ""))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter((d, n_a, n_b, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), s) for d, n_a, n_b, g, x, s in per_doc), counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block_bytes", [1, 3000, 4 << 20])
def test_alignment_matches_a_plain_one(odd, block_bytes):
    got = alignment.align(odd, block_bytes=block_bytes).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == aligned(odd.collect())[0]


def test_alignment_of_documents(spark, empty, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, counts = aligned(docs.collect())
    blocks = alignment.aligned_blocks(docs.repartition(4), block_bytes=30_000)
    assert Counter(map(tuple, alignment.align(docs).select(*COLUMNS).collect())) == want
    assert {(r.a_id, r.b_id): r["count"] for r in alignment.token_map(blocks).collect()} == counts
    assert alignment.align(empty).count() == 0


def test_wide_blocks_number_their_pairs_in_four_bytes():
    aligner = alignment.Aligner(byte_bpe(BYTE_BPE), piece_bpe(PIECE_BPE))
    r = random.Random(5)
    texts = ["".join(chr(r.randint(0x21, 0x2FFF)) for _ in range(4000)) for _ in range(60)]
    wide = aligner.block(texts)
    links = np.frombuffer(wide["links"], "<u4" if wide["wide"] else "<u2")
    assert len(links) == sum(wide["n_links"]) and np.bincount(links).tolist() == wide["counts"].tolist()


def test_a_block_is_aligned_piece_by_piece(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts = [*ODD, *texts, None, "", None]
    aligner = alignment.Aligner(byte_bpe(BYTE_BPE), piece_bpe(PIECE_BPE))
    whole, pieces = aligner.block(texts, 1 << 40), aligner.block(texts, 2000)
    for k, v in whole.items():
        assert np.array_equal(pieces[k], v) if isinstance(v, np.ndarray) else pieces[k] == v, k
    alone = aligner.block([None], 1)
    assert alone["n_links"].tolist() == [0] and alone["links"] == b"" and alone["groups_sha256"] == [""]

    def peak(size):
        tracemalloc.start()
        aligner.block(["One more word for all of us here. " * 300] * size)
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        return most

    # The links that a block gives grow with it, what it takes to find them doesn't.
    assert peak(160) < 3 * peak(40)
