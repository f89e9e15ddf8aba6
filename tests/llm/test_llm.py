"""The operators against brute force, exact round trips and held-out accuracy, and their odd cases."""

import hashlib
import html
import math
import random
import re
import string
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from chronomart.llm import (
    bpe, common, embedding_dedup, exact_dedup, html_extract, jaccard_join, maxent_lm, mixing, quality, queries, shingles, token_files,
    url_filter,
)
from chronomart.llm.html_blocks import blocks

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, node long"
ODD = ["", None, " \n ", "One", "a b c d", "a b c d", "A b c d", "\x1c nul\x00 é́ 汉字 <|endoftext|>'s  ", "x" * 5000, "Word! " * 9000]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if i % 3 else "s", 0, "clash", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "one", None, "z", None, None, None)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def copies(spark):
    """Sixty near copies of one text, exact copies, a shared passage and unrelated texts."""
    r = np.random.default_rng(4)
    vocabulary = ["".join(r.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    base, passage = list(r.choice(vocabulary, 150)), list(r.choice(vocabulary, 60))
    texts = []
    for _ in range(60):
        own = list(base)
        for k in r.integers(0, 150, r.integers(0, 4)):
            own[k] = vocabulary[r.integers(3000)]
        texts.append(" ".join(own))
    texts += [texts[3].upper()] * 20 + [" ".join([*passage, *r.choice(vocabulary, r.integers(5, 90))]) for _ in range(40)]
    texts += [" ".join(r.choice(vocabulary, n)) for n in range(0, 30)]
    return spark.createDataFrame([(i * 7 % 1009, t, "en", "s", 0, "", 0) for i, t in enumerate(texts)], DOCS).repartition(5)


def linked(rows):
    sets = {}
    for r in rows:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    top = {i: i for i in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top[a], top[b]))
                top = {i: low if t == high else t for i, t in top.items()}
    return {(i, len(sets[i]), top[i]) for i in ids}


def test_jaccard_join_loses_no_link(copies):
    rows = copies.collect()
    found = jaccard_join.jaccard_join(copies).collect()
    assert {tuple(r) for r in found} == linked(rows) and len(found) == len(rows)


def test_jaccard_join_compares_signatures_without_overflow_checks(spark, capsys, tmp_path):
    """The join of groups is compiled to small code: its checked sums took an executor memory that stayed."""
    signs = [[0] * 8, [255] + [0] * 7, [-1] * 8, [0] * 8, [1] * 8]
    groups = [10, 11, 12, 13, 13]
    classes = spark.createDataFrame(
        [(g, i, *s) for i, (g, s) in enumerate(zip(groups, signs))], "gid long, node long, " + ", ".join(f"{c} long" for c in jaccard_join.SIGNATURE)
    )
    placed = classes.select("gid", "node", F.col("node").alias("comp"))
    span = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    lists = span.selectExpr("7L as token", "gid", "100L as n", "0 as pos", "low", "high")
    found = jaccard_join.candidates_across(lists, placed, classes, 80)
    # 8 unequal bits leave room for the similarity, 512 don't; a group of several sets is compared with all, and inside.
    assert sorted(map(tuple, found.collect())) == [(0, 1), (0, 3), (0, 4), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
    columns = ["gid", "n", "low", "high", "pos", *jaccard_join.SIGNATURE]
    pair = spark.range(1).selectExpr(*[f"id as {c}_{x}" for c in columns for x in "ab"], *[f"id > 7 as several_{x}" for x in "ab"])
    pair.write.parquet(f"{tmp_path}/pair")
    pair = spark.read.parquet(f"{tmp_path}/pair")
    for condition in ("close_enough", "worth_comparing"):
        pair.where(getattr(jaccard_join, condition)(80)).explain("codegen")
        code = capsys.readouterr().out
        assert "bitCount(" in code and "Exact(" not in code


def test_exact_dedup_matches_sql(spark, sf):
    found = Counter(map(tuple, queries.op4_exact_dedup(spark, sf).collect()))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert found == Counter(duck.execute(queries.OP4_SQL).fetchall())


def test_exact_dedup_splits_buckets_and_chains_collisions(copies):
    plain = {tuple(r)[:5] for r in exact_dedup.exact_dedup(copies).collect()}
    tight = exact_dedup.exact_dedup(copies, capacity=4, key_bits=4).collect()
    assert {tuple(r)[:5] for r in tight} == plain
    assert max(r.chain for r in tight) > 1 and len({r.bucket for r in tight}) > 4
    assert exact_dedup.keep_distinct(copies).count() == len({r.text_sha256 for r in tight})


def test_hypergeometric_draws(spark):
    sql = mixing.hypergeometric("50L", "20L", "15L", "(id + 0.5) / 4000")
    found = Counter(r.x for r in spark.range(4000).selectExpr(f"{sql} AS x").collect())
    for k in range(16):
        want = math.comb(20, k) * math.comb(30, 15 - k) / math.comb(50, 15)
        assert abs(found[k] / 4000 - want) < 2 / 4000


def test_mixing_reaches_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs, block_words=500, shard_draws=4).collect()
    size = {s: sum(len(words(r.text)) for r in rows if r.source == s) for s in {r.source for r in rows}}
    names = sorted(size)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * size[s]}
        if not above:
            break
        target |= {s: 3.0 * size[s] for s in above}
        left, free = left - sum(3 * size[s] for s in above), free - above
    target |= share
    for s in names:
        own = [r["__mix"] for r in rows if r.source == s]
        assert {m.source_size for m in own} == {size[s]} and all(abs(m.target - target[s]) < 1e-6 for m in own)
        assert abs(sum(m.taken for m in own) - target[s]) <= 0.5 and all(m.taken <= 3 * m.size for m in own)
    shards = Counter(d.shard for r in rows for d in r["__mix"].draws)
    assert len(shards) > 4
    again = mixing.mix(docs.repartition(3), block_words=500, shard_draws=4).collect()
    assert {(r.doc_id, str(r["__mix"])) for r in rows} == {(r.doc_id, str(r["__mix"])) for r in again}
    assert mixing.mixture(docs).count() == sum(len(r["__mix"].draws) for r in mixing.mix(docs).collect())


def test_mixture_keeps_texts_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.concat(F.lit("  "), "text", F.lit("\n\tend ")).alias("text"), "source", "n_chars")
    whole = {tuple(r) for r in docs.collect()}
    rows = [tuple(r) for r in mixing.mixture(docs).collect()]
    assert set(rows) <= whole
    targets = {r.source: r["__mix"].target for r in mixing.mix(docs).collect()}
    for source, target in targets.items():
        longest = max(len(words(t)) for _, t, s, _ in whole if s == source)
        assert target - 0.5 <= sum(len(words(t)) for _, t, s, _ in rows if s == source) < target + longest


@pytest.mark.parametrize("texts", [["a b", "c d e f"], []], ids=["some", "none"])
def test_mixing_of_sources_without_words(spark, texts):
    blank = [(9, None, "e"), (8, "", "e"), (7, " \n ", "e"), (6, None, None)]
    docs = spark.createDataFrame([*blank, *((i, t, "s") for i, t in enumerate(texts))], "doc_id long, text string, source string")
    found = {r.doc_id: r["__mix"] for r in mixing.mix(docs).collect()}
    assert len(found) == len(blank) + len(texts)
    assert all((found[i].size, found[i].source_size, found[i].target, found[i].taken) == (0, 0, 0.0, 0) for i in (6, 7, 8, 9))
    assert sum(m.taken for m in found.values()) == 3 * len(texts)
    assert mixing.mixture(docs).where("doc_id >= 6").count() == 0 and mixing.mixture(docs).count() >= len(texts)


def test_embedding_recall_at_the_threshold_and_odd_vectors(spark):
    r = np.random.default_rng(1)
    a = r.standard_normal((400, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.standard_normal((400, 32))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near, far = 0.905 * a + math.sqrt(1 - 0.905**2) * b, 0.89 * a + math.sqrt(1 - 0.89**2) * b
    every = [x.tolist() for x in np.vstack([a, near, -far])]
    odd = [None, [], [0.0] * 32, [None, *[1.0] * 31], [float("nan")] * 32, every[0], every[0], [2 * x for x in every[0]], [1.0, 0.0], [1e300] * 32]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate([*every, *odd])], "vec_id long, embedding array<double>, v string")
    found = {x.vec_id: x for x in embedding_dedup.embedding_dedup(df).collect()}
    unit = np.array(every) / np.linalg.norm(every, axis=1, keepdims=True)
    true = np.triu(unit @ unit.T >= 0.9, 1).sum()
    links = sum(found[i].n_links for i in range(1, 1200)) - (found[400].n_links - 1 if found[400].n_links > 1 else 0)
    assert 0.95 * 2 * true <= links + found[0].n_links <= 2 * true + 12
    assert all(found[1200 + k].n_links == 0 and found[1200 + k].kept for k in (0, 1, 2, 3, 4, 8))
    assert found[1205].component_id == found[1206].component_id == found[1207].component_id == 0


def test_embedding_hot_cell_is_split(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    r = np.random.default_rng(2)
    v = np.ones(16) + 0.01 * r.standard_normal((90, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert {(x.n_links, x.component_id) for x in embedding_dedup.embedding_dedup(df).collect()} == {(89, 0)}


def test_embedding_links_leave_a_block_by_node_not_by_pair(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "AT_ONCE", 7)
    kept = {}

    def spied(df, name):
        kept[name] = common.stored(df, name)
        return kept[name]

    monkeypatch.setattr(embedding_dedup, "stored", spied)
    r = np.random.default_rng(3)
    v = np.repeat(np.eye(16)[:3], 40, axis=0) + 0.01 * r.standard_normal((120, 16))
    v = np.vstack([v, v[:5], -v[:1]])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embedding_dedup.embedding_dedup(df).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    assert found == {i: (int(row.sum()) - 1, int(np.flatnonzero(row)[0]), i == np.flatnonzero(row)[0]) for i, row in enumerate(near)}
    # 120 nodes; a cell of all of them is cut into 8 blocks, of which each meets each.
    assert kept["vector-links"].count() <= 8 * 120 < (near.sum() - len(v)) / 2


def test_html_extraction_of_whole_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    found = {r.page_id: r for r in html_extract.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        want = "\n".join(x for x in parts if x)
        assert found[p.page_id].text == want and found[p.page_id].n_chars == len(want)


def test_html_labeller_on_unseen_layouts_and_gradient():
    layouts = html_extract.Layouts(99)
    samples = [s for s in (layouts.sample() for _ in range(200)) if s[0]]
    labels = html_extract.Labeller(html_extract.trained())([s[0] for s in samples])
    assert np.concatenate([x == (s[1] > 0) for x, s in zip(labels, samples)]).mean() > 0.96
    own = html_extract.initial(1)
    x, mask = html_extract.padded([html_extract.features(s[0][:6]) for s in samples[:3]])
    y = np.random.default_rng(0).integers(0, 2, mask.shape).astype(float)

    def loss():
        z = html_extract.scores(own, x, mask)[0]
        return float(((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum())

    grad = html_extract.gradients(own, x, mask, y)
    for name in own:
        at = np.unravel_index(np.abs(grad[name]).argmax(), own[name].shape)
        kept = own[name][at]
        own[name][at] = kept + 1e-5
        high = loss()
        own[name][at] = kept - 1e-5
        assert abs((high - loss()) / 2e-5 - grad[name][at]) < 1e-5
        own[name][at] = kept


def test_html_labeller_reads_all_words_of_a_block():
    page = [blocks("<p>" + " ".join([*["word"] * 100, last]) + "</p>") for last in ("final", "tail")]
    one, other = (html_extract.described(p)[0, : html_extract.WORDS] for p in page)
    assert len(set(map(html_extract._word_bin, ("word", "final", "tail")))) == 3
    assert (one != other).sum() == 2 and abs(one.sum() - 1) < 1e-9 and one[html_extract._word_bin("final")] == pytest.approx(1 / 101)


def test_html_blocks_of_broken_pages():
    page = "<p>a&amp b<br>c<p>d <b>e</p><ul><li>x<li>y</ul><script>if (a<b) '</p>'</script>&lt;z&#233;<!-- q --><div>t"
    assert [b.text for b in blocks(page)] == ["a& b c", "d e", "x", "y", "<zé", "t"]
    assert blocks(None) == [] and blocks("") == [] and blocks("<") and blocks("<p" * 2000) is not None


@pytest.mark.parametrize("name", ["svg", "math", "object", "select"])
def test_html_element_without_end_loses_nothing(name):
    page = f"<article><h1>t</h1><p>a <{name} x='1'></p><p>b<div>c</div></article><footer>d</footer>"
    assert [b.text for b in blocks(page)] == ["t", "a", "b", "c", "d"]
    page = f"<article><p>a</p><{name}><p>b</p><p>c</p></article><footer>d</footer>"
    assert [b.text for b in blocks(page)] == ["a", "b", "c", "d"] and blocks(page)[-1].path == (("footer",),)


def test_html_formulas_objects_drawings_and_choices():
    page = "<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then <svg><title>icon</title><path d='M0'/></svg>so.</p>"
    assert [b.text for b in blocks(page)] == ["If x=2 then so."]
    page = "<object data='a'><object data='b'><p>one</object><p>two</object>three<svg><svg><text>Jan</text></svg><text>Feb</text></svg>"
    assert [b.text for b in blocks(page)] == ["one", "two", "three Jan Feb"] and blocks(page)[1].path == (("object",), ("p",))
    page = "<p>Take <select><optgroup><option>x<option>y</select> now</p>"
    assert [(b.text, b.path[-1][0]) for b in blocks(page)] == [("Take", "p"), ("x", "option"), ("y", "option"), ("now", "p")]


def test_html_article_around_embedded_elements():
    text = "<p>Lorem ipsum dolor sit amet, consetetur sadipscing elitr, sed diam nonumy eirmod tempor.</p>"
    label = html_extract.Labeller(html_extract.trained())
    for part in ("<svg>", "<math>", "<object data='x'>", f"<object data='x'>{text}</object>", "<p>if <math><mi>x</mi></math> then so it is.</p>"):
        page = blocks(f"<body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><article><h1>Title of it</h1>{text}{part}{text * 3}</article><footer>&copy; us</footer>")
        assert label([page])[0].tolist() == ["article" in [x[0] for x in b.path] for b in page], part


def test_quality_against_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = {r.doc_id: r.kept for r in queries.op3_quality(spark, sf).collect()}
    clean = [found[i] for i, q in labels.items() if q == 1]
    junk = [found[i] for i, q in labels.items() if q == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.05


def test_url_rules_and_viterbi(spark):
    rows = [
        (1, "HTTP://A.Net/x", ""), (2, "http://Sub.EXAMPLE.net/en/?q", None), (3, "a://b.org/fr/x://y", ""), (4, "x", ""), (5, None, ""),
        (6, "http://a.net", ""), (7, "http://fakenet/", ""), (8, "http://example.com/de/#a?b", "<p>the cat the cat</p>"), (8, None, None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = Counter(tuple(r)[:4] for r in url_filter.filter_urls(df).collect())
    assert found == Counter([
        (1, "a.net", "/x", "net/"), (2, "sub.example.net", "/en/", "example.net/en/"), (3, "b.org", "/fr/x://y", "org/fr/"), (4, "", "", None),
        (5, "", "", None), (6, "a.net", "", None), (7, "fakenet", "/", None), (8, "example.com", "/de/", "example.com/de/"), (8, "", "", None),
    ])
    log = {"the": -2.0, "cat": -3.0, "thec": -9.0}
    assert url_filter.best_split("thecatthe", log, -6.0) == ["the", "cat", "the"]


def test_url_verdicts_follow_naive_bayes(spark):
    df = spark.createDataFrame(
        [(i, f"http://{'bad' if i % 2 else 'good'}.{'net' if i % 2 else 'org'}/{'sale' if i % 2 else 'fr'}/{i}", "bad good") for i in range(20)]
        + [(100, "http://bad.io/sale/7", ""), (101, "http://good.io/fr/7", "")], "page_id long, url string, html string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert found[100] == (None, "block") and found[101] == (None, "allow") and found[0] == ("org/fr/", "allow")


def test_bpe_equals_the_library(spark, odd):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    library.no_padding()
    library.no_truncation()
    r = np.random.default_rng(3)
    letters = [*"ab  \n\t\x0b\x1c'sté汉!.19THE\x00", "<|endoftext|>", " the", "!!!!", "aaaa"]
    texts = ["".join(r.choice(letters, r.integers(0, 50))) for _ in range(1500)] + [t or "" for t in ODD] + ["ab" * 400]
    codec = bpe.Codec(bpe.TOKENIZER, bpe.Lexicon(bpe.compiled([b" the", b" th"], codec_ids([b" the", b" th"]))))
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and codec.decode(ids) == library.decode(want, skip_special_tokens=False)
    for row in bpe.round_trip(odd).collect():
        text = "one" if row.doc_id is None else ODD[row.doc_id] or ""
        want = library.encode(text, add_special_tokens=False).ids
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(odd)).collect()}
    assert back[7] == ODD[7] and back[1] == ""


def codec_ids(items):
    return bpe.Codec(bpe.TOKENIZER).vocabulary.merge(items)


def test_lexicon_shares_suffixes():
    items = [b"walking", b"talking", b"walked", b"talked", b"walk", b"talk"]
    lexicon = bpe.Lexicon(bpe.compiled(items, [[i, 10 + i] for i in range(6)]))
    assert [lexicon.get(w).tolist() for w in items] == [[i, 10 + i] for i in range(6)]
    assert lexicon.get(b"wal") is None and lexicon.get(b"") is None and lexicon.get(b"walks") is None
    assert len(lexicon.final) == 9


def test_remembered_words_survive_forgetting(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    library, codec, words_ = Tokenizer.from_file(bpe.TOKENIZER), bpe.Codec(bpe.TOKENIZER), token_files.Words(token_files.TOKENIZER)
    library.no_truncation()
    for k in range(30):
        text = f"The word{k}, the last. w{k - 1} word{k - 2}, Ab{'c' * k}. Zw{'x' * (k % 7)}"
        assert codec.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert words_.encode([text])[0].tolist() == [*words_.tokenizer.encode(text, add_special_tokens=False).ids, token_files.END]


def test_words_equal_the_library():
    r = np.random.default_rng(4)
    letters = [*"abAB  \n\t\x0b'sté汉İǅßſﬁक़\u0301\u00a0.,19!THE\x00", "<|endoftext|>", " the.", "e\u0301,", "don't ", " İ ", " K "]
    texts = ["".join(r.choice(letters, r.integers(0, 50))) for _ in range(3000)] + [t or "" for t in ODD]
    words_ = token_files.Words(token_files.TOKENIZER)
    for text, ids in zip(texts, words_.encode(texts)):
        assert ids.tolist() == [*words_.tokenizer.encode(text, add_special_tokens=False).ids, token_files.END]


def test_token_files_look_a_word_of_a_batch_up_once():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    words_ = token_files.Words(token_files.TOKENIZER)
    words_.known = Counted()
    texts = [" the same words\x0b\tthe same\x1c words, \n", "the " * 500, "", " ", "a <|endoftext|> b", "\ud800".encode("utf-8", "replace").decode(), "é É\x85x"] * 20
    for text, ids in zip(texts, words_.encode(texts)):
        assert ids.tolist() == [*words_.tokenizer.encode(text, add_special_tokens=False).ids, token_files.END]
    assert Counted.asked < 50


@pytest.mark.parametrize("n", [1, 31, 33, token_files.BLOCK, token_files.BLOCK + 1])
def test_rans_round_trip_and_checksum(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n), 49_000).astype(np.uint32)
    table, data = token_files.encode_blocks(ids)
    symbols, freq, _ = token_files.table_from(table, 0)
    assert freq.sum() == 1 << token_files.SCALE
    assert (np.concatenate(token_files.decode_blocks(symbols, freq, data)) == ids).all()
    assert (token_files.decode_blocks(symbols, freq, data[-1:])[0] == ids[(len(data) - 1) * token_files.BLOCK :]).all()
    broken = bytearray(data[0])
    broken[12] ^= 1
    with pytest.raises(ValueError):
        token_files.decode_blocks(symbols, freq, [bytes(broken)])


def test_words_equal_the_library():
    words = token_files.Words(token_files.TOKENIZER)
    library = Tokenizer.from_file(token_files.TOKENIZER)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(4)
    plain = [t.removesuffix("</w>") for t in library.get_vocab()]
    plain = [t for t in plain if t.isascii() and t.isalpha()]
    made = plain + ["".join(rng.choices(plain, k=2)) for _ in range(20_000)]
    made += ["".join(rng.choices(string.ascii_letters, k=rng.randint(1, 40))) for _ in range(10_000)]
    made += [c * k for c in string.ascii_letters for k in (1, 2, 3, 7, 500)]
    data = [w.encode() for w in made]
    want = [np.array(e.ids, np.uint32).tobytes() for e in library.encode_batch(made, add_special_tokens=False)]
    assert words.ascii.encode(data) == want
    stops = ["", ".", ",", "!!", "?!", "&&&", "$$$", "###", "***", "%%%", ";:", "'", "'s", "'.", ".'s", "1", ".1", "-a", "é.", "İ,", "ß!!", "ﬁ.", "́,"]
    texts = [f"{w}{a} {v}{b}" for w, v in zip(made[::97], made[1::97]) for a, b in [rng.choices(stops, k=2)]]
    found = words.encode(texts)
    assert all(f.tolist() == [*e.ids, 1] for f, e in zip(found, library.encode_batch(texts, add_special_tokens=False)))


def test_token_files_equal_the_library(odd, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 64)
    library = Tokenizer.from_file(token_files.TOKENIZER)
    library.no_padding()
    library.no_truncation()
    rows = sorted(odd.collect(), key=lambda r: (-1 if r.doc_id is None else r.doc_id, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert Counter(map(tuple, token_files.token_files(odd).collect())) == Counter(want)


def test_language_model_counts_and_gain(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: [*words(r.text), "\n"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    count = Counter(w for i, d in docs.items() if not held[i] for w in d)
    n, v = sum(count.values()), len(count)
    found = queries.op10_maxent_lm(spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        d = docs[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in d)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(d), sum(count[w] > 0 for w in d), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    assert sum(r.score - r.base_score for r in found if r.held_out) > 0.05 * sum(r.n_tokens for r in found if r.held_out)


def test_language_model_scores_do_not_follow_the_files(spark, sf, monkeypatch):
    monkeypatch.setattr(maxent_lm, "SHARD", 20_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null").limit(200)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    found = [{r.doc_id: r.score for r in maxent_lm.score(docs.repartition(n)).collect()} for n in (1, 16)]
    assert found[0].keys() == found[1].keys()
    assert all(abs(a - found[1][i]) <= 1e-6 * abs(a) for i, a in found[0].items())


def test_words_of_texts_read_together():
    texts = [*ODD, None, "ab\tc " * 300_000, "", "é"]
    hashes, tails, counts = shingles.words_of_all(texts)
    assert counts.tolist() == [len(words(t)) for t in texts]
    assert np.array_equal(hashes, np.concatenate([shingles.word_hashes(t) for t in texts]))
    last = [b"\x00" * (len(w) < 2) + w[-2:] for t in texts for w in (x.encode() for x in words(t))]
    assert tails.tolist() == [int.from_bytes(x, "big") for x in last]
    assert [t for some in shingles.together(texts, 4000) for t in some] == texts
    assert shingles.words_of_all([""])[2].tolist() == [0]


def test_features_of_documents_together():
    rng = np.random.default_rng(6)
    counts = np.array([0, 3, 0, 1, 40, 2, 0])
    classes, hashes = rng.integers(1, maxent_lm.CLASSES, counts.sum()), rng.integers(0, 1 << 63, counts.sum()).astype(np.uint64)
    found, target = maxent_lm.features(classes, hashes, counts)
    row = lambda x, salt, k: 1 + sum(maxent_lm.KINDS[:k]) + int(shingles.mixed(np.array([x], np.uint64), salt)[0]) % maxent_lm.KINDS[k]
    want, wanted = [], []
    for end, n in zip(np.cumsum(counts), counts):
        c, h = [0, 0, 0, *classes[end - n : end], 0], [maxent_lm.END_HASH] * 3 + [*hashes[end - n : end], maxent_lm.END_HASH]
        for i in range(3, len(c)):
            one, two, three = (int(x) for x in (c[i - 1], c[i - 2], c[i - 3]))
            want.append([1 + one, row(one * 64 + two, 11, 1), row(h[i - 1], 13, 2), row(two * 64 + three, 12, 3), row(h[i - 2], 14, 4)])
            wanted.append(c[i])
    assert found.T.tolist() == want and target.tolist() == wanted


def test_sums_of_runs():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 1000):
        key = np.sort(rng.integers(0, 9, n))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        values = rng.normal(size=(n, 4))
        want = np.array([values[key == k].sum(0) for k in np.unique(key)])
        assert np.allclose(maxent_lm.run_sums(values, first), want)


def test_sums_of_runs_at_positions():
    rng = np.random.default_rng(4)
    key, at = np.sort(rng.zipf(1.5, 3000) % 500), rng.integers(0, 600, 3000)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    values = rng.normal(size=(600, 4))
    want = np.array([values[at[key == k]].sum(0) for k in np.unique(key)])
    assert np.diff(first).max() > 2 * maxent_lm.STEPS and np.allclose(maxent_lm.run_sums(values, first, at), want)


@pytest.mark.parametrize("scale", [1, 1000])
def test_exponentials_of_long_texts_in_steps(scale):
    rng = np.random.default_rng(5)
    n = 2 * maxent_lm.CACHED + 3
    w = (scale * rng.normal(size=(50, maxent_lm.CLASSES))).astype(np.float32)
    rows, target = rng.integers(1, 50, (5, n)).astype(np.uint16), rng.integers(0, maxent_lm.CLASSES, n)
    found, sums, own = maxent_lm.exponentials(w, rows, target)
    z = w[rows].sum(0).astype(np.float64) + w[0]
    want = z - z.max(1, keepdims=True) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True))
    assert np.isfinite(found).all() and np.allclose(own - np.log(sums), want[np.arange(n), target], rtol=1e-4, atol=1e-3 * scale)


@pytest.mark.parametrize("run", [
    exact_dedup.exact_dedup, exact_dedup.keep_distinct, mixing.mix, mixing.mixture, jaccard_join.jaccard_join,
    jaccard_join.keep_representatives, quality.classify, quality.keep_good, bpe.round_trip, token_files.token_files, maxent_lm.score,
], ids=lambda f: f"{f.__module__.rsplit('.', 1)[-1]}.{f.__name__}")
def test_odd_and_empty_tables(odd, empty, run):
    assert run(empty).count() == 0
    rows = run(odd).collect()
    if run.__name__ not in ("keep_distinct", "keep_representatives", "keep_good", "mixture"):
        assert len(rows) == odd.count()
    else:
        assert set(run(odd).columns) == set(odd.columns) and rows


def test_odd_pages_and_vectors_of_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(pages).count() == 0 and url_filter.filter_urls(pages).count() == 0
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "<div><p>")], "page_id long, url string, html string")
    assert [r.text for r in html_extract.extract(odd).collect()] == ["", "", ""]


def test_batches_of_long_rows_stay_small(spark):
    before = {name: spark.conf.get(name) for name in (common.BATCH, common.BATCH_BYTES)}

    def lengths(batches):
        for batch in batches:
            yield batch.iloc[:1].assign(text="", n=len(batch))

    rows = spark.range(0, 64, 1, 1).select(F.expr("repeat('x', 1000000)").alias("text"))
    with common.small_batches(spark):
        assert max(r.n for r in rows.mapInPandas(lengths, "text string, n long").collect()) <= 8
    assert before == {name: spark.conf.get(name) for name in before}


def test_quality_reads_small_batches(spark, odd, monkeypatch):
    seen = []

    def spied(df, name):
        seen.append((name, int(spark.conf.get(common.BATCH))))
        return common.stored(df, name)

    monkeypatch.setattr(quality, "stored", spied)
    kept = quality.keep_good(odd)
    assert seen == [("votes", 1000)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan


def test_sketch_leaves_a_worker_in_parts():
    texts = [" ".join(f"w{i}-{j}" for j in range(300)) for i in range(60)]
    frames = list(jaccard_join._mark(5)(iter([pd.DataFrame({"doc_id": range(60), "text": texts})])))[1:]
    assert sum(len(f) for f in frames) == 64 and max(sum(map(len, f["counts"])) for f in frames) <= 1 << 20
    assert sum(np.frombuffer(c, np.int64).sum() for f in frames for c in f["counts"]) == 60 * 296


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    texts = [(r.text or "").translate(LOWER) for r in docs.collect()]
    assert len(texts) == len(set(texts))
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


CLASHES = ["target", "idx", "of", "n_blocks", "source_size", "size", "taken", "shard", "__plan", "__mix", "__block", "__text", "__row", "__junk", "__id", "__c0", "junk", "key"]


def test_stages_keep_columns_of_any_name(spark, odd, empty):
    wide = lambda df: df.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")) for c in CLASHES})
    for df in (odd, empty):
        docs = wide(df)
        for stage in (quality.keep_good, exact_dedup.keep_distinct, jaccard_join.keep_representatives, mixing.mixture):
            found = stage(docs)
            assert found.columns == docs.columns, stage
            plain = stage(df)
            key = lambda r: str(tuple(r))
            rows = found.collect()
            assert sorted(map(key, found.select(*df.columns).collect())) == sorted(map(key, plain.collect())), stage
            assert all(r[c] == f"{c}{r.doc_id or 0}" for r in rows for c in CLASHES), stage
    assert mixing.mix(wide(odd)).columns == [c for c in wide(odd).columns if c != "__mix"] + ["__mix"]
