"""Main text of web pages by a recurrent block labeller in numpy.

A page is the sequence of its leaf blocks. A bidirectional LSTM reads, per block, the
hashed names on its tag path, its hashed words and a few measures, and labels it as
article or not with the whole page as context. It is trained here, on page layouts
drawn from a seeded generator, whose blocks carry their label by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.html_blocks import Block, blocks

PATH, WORDS, MEASURES, HIDDEN = 384, 48, 6, 20
INPUT = PATH + WORDS + MEASURES
#: Blocks in one scoring batch, padding included.
BATCH_BLOCKS = 16384

#: Names of containers in the generated layouts.
ARTICLE_NAMES = "article content post entry story main body text page blog news single hentry markdown prose".split()
OTHER_NAMES = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager toc links tabs".split(),
    "header": "header masthead topbar banner logo branding site head".split(),
    "footer": "footer copyright legal bottom colophon credits foot".split(),
    "side": "sidebar aside widget related recommended trending popular rail more archive tags".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay warning message hidden banner".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adslot adsense commercial".split(),
    "form": "form search login signup newsletter subscribe contact register".split(),
    "comments": "comments comment replies reply discussion disqus respond commentlist feedback responses".split(),
    "share": "share social sharing follow buttons author byline meta rating".split(),
}
TAGS = {
    "menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"],
    "notice": ["div", "section", "aside", "dialog"], "advert": ["div", "aside", "section", "ins"], "form": ["form"],
    "comments": ["section", "div", "ol", "ul"], "share": ["div", "ul"],
}


class Layouts:
    """Pages of many layouts with the label of each block."""

    def __init__(self, seed: int) -> None:
        self.r = np.random.default_rng(seed)

    def one(self, items):
        return items[self.r.integers(len(items))]

    def words(self, low: int, high: int) -> str:
        n = self.r.integers(low, high + 1)
        letters = self.r.integers(97, 123, (n, 8)).astype(np.uint8)
        sizes = self.r.integers(1, 9, n)
        text = " ".join(bytes(letters[i, : sizes[i]]).decode() for i in range(n))
        return text.capitalize() + self.one([".", ".", "", "!", "?"])

    def attributes(self, names: list[str]) -> str:
        if self.r.random() < 0.12:
            return ""
        own = [self.one(names)] + (["x" + "".join(self.one("abcdefgh") for _ in range(4))] if self.r.random() < 0.3 else [])
        return f' {self.one(["class", "class", "class", "id"])}="{self.one(["", "", "site-", "c_"])}{self.one(["-", " ", "_"]).join(own)}"'

    def linked(self) -> str:
        return f'<a href="/x">{self.words(1, 4)}</a>' if self.r.random() < 0.6 else self.words(1, 8)

    def other(self, kind: str) -> str:
        tag = self.one(TAGS[kind])
        names = OTHER_NAMES[kind]
        named = self.attributes(names)
        while tag in ("div", "section", "ul", "ol", "dialog") and not named:
            named = self.attributes(names)
        if tag in ("ul", "ol") or kind in ("menu", "side") and self.r.random() < 0.6:
            inner = "".join(f"<li>{self.linked()}</li>" for _ in range(self.r.integers(1, 9)))
            inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = "".join(f"<{t}>{self.words(2, 60)}</{t}>" for t in [self.one(["p", "div", "p"])] * self.r.integers(1, 7))
        elif kind == "form" and self.r.random() < 0.5:
            inner = f"<p>{self.words(1, 6)} {self.choice()}</p>"
        else:
            inner = "".join(self.one([f"<p>{self.words(1, 40)}</p>", f"<div>{self.linked()}</div>", self.words(1, 20), f"<h3>{self.words(1, 5)}</h3>"]) for _ in range(self.r.integers(1, 4)))
        if kind in ("header", "share", "advert") and self.r.random() < 0.05:
            inner = self.one([f"<svg><text>{self.words(1, 3)}</text></svg>", f"<object><p>{self.words(1, 9)}</p></object>"]) + inner
        return f"<{tag}{named}>{inner}</{tag}>"

    def choice(self) -> str:
        options = "".join(f"<option>{self.words(1, 3)}</option>" for _ in range(self.r.integers(1, 6)))
        return f"<select>{options}{self.one(['</select>', '</select>', ''])}"

    def embedded(self) -> str:
        """A formula, a drawing or an object of the article; a choice in it is not of the article."""
        end = self.one(["", "</{}>", "</{}>"])
        text = f"<p>{self.words(1, 40)}</p>"
        return self.one([
            f"<p>{self.words(1, 30)} <math><mi>x</mi><mo>=</mo><mn>2</mn>{end.format('math')} {self.words(1, 30)}</p>",
            f"<svg><text>{self.words(1, 4)}</text>{end.format('svg')}{text}", f"<object data='/o'>{text}{text}{end.format('object')}{text}",
            f"\ue001{self.choice()}\ue000{text}",
        ])

    def body(self) -> str:
        out = []
        for _ in range(self.r.integers(1, 13)):
            x = self.r.random()
            if x < 0.06:
                out.append(self.embedded())
            elif x < 0.72:
                text = self.words(1, 70)
                out.append(self.one([f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<p>{text} <a href='/y'>{self.words(1, 5)}</a> {self.words(1, 9)}</p>", f"<div>{text}</div>"]))
            elif x < 0.82:
                out.append(f"<h{self.one('234')}>{self.words(1, 9)}")
                out[-1] += f"</h{out[-1][2]}>"
            elif x < 0.88:
                out.append("<ul>" + "".join(f"<li>{self.words(1, 20)}</li>" for _ in range(self.r.integers(1, 6))) + "</ul>")
            elif x < 0.93:
                out.append(f"<{self.one(['blockquote', 'pre', 'figcaption'])}>{self.words(1, 40)}")
                out[-1] += f"</{out[-1][1 : out[-1].index('>')]}>"
            else:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 5)}</td><td>{self.words(1, 5)}</td></tr>" for _ in range(self.r.integers(1, 4))) + "</table>")
        return "".join(out)

    def page(self) -> str:
        """A page whose article parts stand between two private-use characters."""
        mark = lambda text: text and f"\ue000{text}\ue001"
        kinds = [k for k in OTHER_NAMES]
        before = "".join(self.other(self.one(["menu", "header", "advert", "notice", "form", "side", "share"])) for _ in range(self.r.integers(0, 4)))
        tag = self.one(["article", "article", "main", "div", "div", "section", "td"])
        named = self.attributes(ARTICLE_NAMES)
        parts = [mark(f"<h1>{self.words(1, 12)}</h1>")] if self.r.random() < 0.75 else []
        for _ in range(self.r.integers(1, 4)):
            parts.append(mark(self.body()))
            if self.r.random() < 0.3:
                parts.append(self.other(self.one([k for k in kinds if k not in ("header", "footer")])))
        inner = "".join(parts)
        if self.r.random() < 0.3:
            inner = f"<div{self.attributes(ARTICLE_NAMES)}>{inner}</div>"
        article = f"<{tag}{named}>{inner}</{tag}>"
        after = "".join(self.other(self.one(["side", "comments", "footer", "footer", "advert", "form", "notice", "share", "menu"])) for _ in range(self.r.integers(0, 5)))
        whole = before + article + after
        for _ in range(self.r.integers(0, 3)):
            whole = f"<div{self.attributes(['wrapper', 'container', 'page', 'layout', 'row', 'col', 'site'])}>{whole}</div>"
        return f"<html><body>{whole}</body></html>"

    def sample(self) -> tuple[list[Block], np.ndarray]:
        """Blocks and labels of one page; the marks are read off and removed."""
        inside, found, labels = False, [], []
        for block in blocks(self.page()):
            label = inside or "\ue000" in block.text
            for c in block.text:
                inside = c == "\ue000" or inside and c != "\ue001"
            block.text = " ".join(block.text.replace("\ue000", " ").replace("\ue001", " ").split())
            if block.text:
                found.append(block)
                labels.append(label)
        return found, np.array(labels, np.float64)


@lru_cache(maxsize=1 << 16)
def _path_bins(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    names = [(name, name) for element in path for name in element if name not in ("html", "body")]
    names += [(f"own {name}", name) for element in path[-1:] for name in element]
    return np.unique([crc32(key.encode()) % PATH for key, _ in names] or [0])


@lru_cache(maxsize=1 << 16)
def _word_bin(word: str) -> int:
    return crc32(word.lower().encode("utf-8", "replace")) % WORDS


def described(flat: list[Block]) -> np.ndarray:
    """Hashed words and measures of blocks, over all words of a block."""
    x = np.zeros((len(flat), WORDS + MEASURES))
    views = [block.text.split(" ") for block in flat]
    sizes = np.array([len(v) for v in views])
    np.add.at(x, (np.repeat(np.arange(len(flat)), sizes), [_word_bin(w) for v in views for w in v]), np.repeat(1 / np.maximum(sizes, 1), sizes))
    n = np.array([len(b.text) for b in flat])
    x[:, WORDS] = np.log1p(n) / 5
    x[:, WORDS + 1] = np.minimum(1, np.array([b.linked for b in flat]) / n)
    x[:, WORDS + 2] = sizes < 4
    x[:, WORDS + 3] = [b.text[-1] in ".!?" for b in flat]
    x[:, WORDS + 4] = [len(b.path) / 10 for b in flat]
    x[:, WORDS + 5] = 1
    return x


def features(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), INPUT))
    for i, block in enumerate(page):
        x[i, _path_bins(block.path)] = 1
    x[:, PATH:] = described(page)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    own = {}
    for side in "fb":
        own[f"x{side}"] = r.standard_normal((INPUT, 4 * HIDDEN)) * 0.15
        own[f"h{side}"] = r.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.15
        own[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    own["o"] = r.standard_normal(2 * HIDDEN) * 0.15
    own["d"] = np.zeros(INPUT)
    own["e"] = np.zeros(1)
    return own


def _run(own, side: str, x: np.ndarray, mask: np.ndarray):
    """Hidden states of one direction over padded (pages, blocks, inputs), and what the gradient needs."""
    pages, steps, _ = x.shape
    gates_in = x @ own[f"x{side}"] + own[f"c{side}"]
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    states, kept = np.zeros((pages, steps, HIDDEN)), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = gates_in[:, t] + h @ own[f"h{side}"]
        s = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t, None]
        new = f * c + i * g
        top = np.tanh(new)
        kept.append((t, h, c, i, f, o, g, top, m))
        c = m * new + (1 - m) * c
        h = m * (o * top) + (1 - m) * h
        states[:, t] = h
    return states, kept


def scores(own, x: np.ndarray, mask: np.ndarray):
    forward, fk = _run(own, "f", x, mask)
    backward, bk = _run(own, "b", x, mask)
    both = np.concatenate([forward, backward], axis=2)
    return both @ own["o"] + x @ own["d"] + own["e"], both, fk, bk


def gradients(own, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    z, both, fk, bk = scores(own, x, mask)
    dz = (_sigmoid(z) - y) * mask / mask.sum()
    grad = {"o": np.einsum("bt,bth->h", dz, both), "d": np.einsum("bt,bti->i", dz, x), "e": np.array([dz.sum()])}
    for side, kept, at in (("f", fk, 0), ("b", bk, HIDDEN)):
        out = dz[:, :, None] * own["o"][at : at + HIDDEN]
        dx = np.zeros((*x.shape[:2], 4 * HIDDEN))
        dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
        grad[f"h{side}"] = np.zeros_like(own[f"h{side}"])
        for t, h0, c0, i, f, o, g, top, m in reversed(kept):
            dh = dh + out[:, t]
            live, cell = dh * m, dc * m
            cell = cell + live * o * (1 - top**2)
            d = np.concatenate([cell * g * i * (1 - i), cell * c0 * f * (1 - f), live * top * o * (1 - o), cell * i * (1 - g**2)], axis=1)
            dx[:, t] = d
            grad[f"h{side}"] += h0.T @ d
            dh = dh * (1 - m) + d @ own[f"h{side}"].T
            dc = dc * (1 - m) + cell * f
        grad[f"x{side}"] = np.einsum("bti,btg->ig", x, dx, optimize=True)
        grad[f"c{side}"] = dx.sum((0, 1))
    return grad


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, INPUT)), np.zeros((len(pages), steps))
    for k, p in enumerate(pages):
        x[k, : len(p)], mask[k, : len(p)] = p, 1
    return x, mask


@lru_cache(maxsize=2)
def trained(pages: int = 900, epochs: int = 7, seed: int = 11) -> dict[str, np.ndarray]:
    """The labeller's weights: Adam on the cross entropy of generated layouts. Same seed, same weights."""
    layouts = Layouts(seed)
    data = [s for s in (layouts.sample() for _ in range(pages)) if s[0]]
    data = sorted(((features(b), y) for b, y in data), key=lambda s: len(s[1]))
    own, r = initial(seed), np.random.default_rng(seed)
    batches = [data[k : k + 32] for k in range(0, len(data), 32)]
    first = {k: np.zeros_like(v) for k, v in own.items()}
    second = {k: np.zeros_like(v) for k, v in own.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs)
        for k in r.permutation(len(batches)):
            x, mask = padded([s[0] for s in batches[k]])
            x = x * (r.random(x.shape) > 0.1)
            y = np.zeros(mask.shape)
            for j, s in enumerate(batches[k]):
                y[j, : len(s[1])] = s[1]
            step += 1
            for name, g in gradients(own, x, mask, y).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                own[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return own


def _states(gates: np.ndarray, inner: np.ndarray, mask: np.ndarray, back: bool) -> np.ndarray:
    """Hidden states over padded gate inputs, for scoring."""
    pages, steps, _ = gates.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out = np.zeros((pages, steps, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        z = gates[:, t] + h @ inner
        s = _sigmoid(z[:, : 3 * HIDDEN])
        m = mask[:, t, None]
        new = s[:, HIDDEN : 2 * HIDDEN] * c + s[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN :])
        c = m * new + (1 - m) * c
        h = m * (s[:, 2 * HIDDEN :] * np.tanh(new)) + (1 - m) * h
        out[:, t] = h
    return out


class Labeller:
    """Scores pages with fixed weights; what a tag path adds to the gates is computed once per path."""

    def __init__(self, own: dict[str, np.ndarray]) -> None:
        self.own = {k: v.astype(np.float32) for k, v in own.items()}
        self.inputs = np.concatenate([self.own["xf"], self.own["xb"], self.own["d"][:, None]], axis=1)
        self.base = np.concatenate([self.own["cf"], self.own["cb"], self.own["e"]])
        self.paths: dict[tuple, np.ndarray] = {}

    def _path(self, path: tuple[tuple[str, ...], ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 1 << 16:
                self.paths.clear()
            self.paths[path] = self.inputs[_path_bins(path)].sum(0) + self.base
        return self.paths[path]

    def gates(self, flat: list[Block]) -> np.ndarray:
        return np.stack([self._path(b.path) for b in flat]) + described(flat).astype(np.float32) @ self.inputs[PATH:]

    def __call__(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks belong to the article."""
        found = [np.zeros(len(p), bool) for p in pages]
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= BATCH_BLOCKS:
                end += 1
            chosen = order[at:end]
            flat = self.gates([b for k in chosen for b in pages[k]])
            x = np.zeros((len(chosen), len(pages[chosen[-1]]), flat.shape[1]), np.float32)
            mask = np.zeros(x.shape[:2], np.float32)
            for j, k in enumerate(chosen):
                mask[j, : len(pages[k])] = 1
            x[mask > 0] = flat
            half = 4 * HIDDEN
            z = x[:, :, -1] + _states(x[:, :, :half], self.own["hf"], mask, False) @ self.own["o"][:HIDDEN]
            z += _states(x[:, :, half : 2 * half], self.own["hb"], mask, True) @ self.own["o"][HIDDEN:]
            for j, k in enumerate(chosen):
                found[k] = z[j, : len(pages[k])] > 0
            at = end
        return found


def _extract(weights):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        label = Labeller(weights.value)
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.iloc[k : k + 512]
                pages = [blocks(page) for page in part["html"]]
                texts = ["\n".join(b.text for b, yes in zip(page, kept) if yes) for page, kept in zip(pages, label(pages))]
                yield pd.DataFrame({
                    "page_id": part["page_id"].astype("Int64").values, "url": part["url"].values, "text": texts,
                    "n_chars": [len(t) for t in texts], "n_blocks": [len(p) for p in pages],
                })

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_blocks.

    ``text`` joins the article's blocks in page order by one line feed; inside a block
    white space is one space and character references are decoded. Null or empty html,
    and pages without an article, give the empty text. Nothing is cut. Repeated rows
    are treated alike; null ids and urls are passed on; an empty table gives an empty
    result; other columns are not looked at.
    """
    weights = pages.sparkSession.sparkContext.broadcast(trained())
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInPandas(_extract(weights), "page_id long, url string, text string, n_chars long, n_blocks long")
