"""Word and shingle hashes of texts in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

#: ASCII white space, the separators of words.
SPACES = b" \t\n\x0b\x0c\r"
PIECE = 1 << 20
_INSIDE = np.ones(256, bool)
_INSIDE[list(SPACES)] = False
_ROWS = 4096
_R = np.random.default_rng(20).integers(1, 1 << 63, (2, _ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_K = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed bijection of 64-bit words that spreads every bit."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words."""
    chars = np.frombuffer(b" %b " % data, np.uint8)
    inside = _INSIDE[chars]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lengths = ends - starts
    chars = chars[inside]
    first = np.cumsum(lengths) - lengths
    at = np.arange(len(chars))
    at -= np.repeat(first, lengths)
    if lengths.max() <= _ROWS:
        weight = np.take(_R[0], at)
    else:
        weight = _R[0][at % _ROWS] + _R[1][(at // _ROWS) % _ROWS] * (at >= _ROWS)
    weight *= chars.astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(weight, first) + lengths.astype(np.uint64) * _K[0]), starts, ends


def _pieces(data: bytes):
    """``data`` in pieces of about 1 MB that end between words, each with its start."""
    start = 0
    while start < len(data):
        end = min(len(data), start + PIECE)
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield start, data[start:end]
        start = end


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased, in text order; works on pieces of 1 MB."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(data) <= PIECE:
        return _piece(data)[0]
    return np.concatenate([_piece(piece)[0] for _, piece in _pieces(data)])


def words_of_all(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all texts, one text after the other: (hashes as ``word_hashes`` has them, their last two bytes as
    a number, 256 times the one before, 0 if none, plus the last), and how many words each text has."""
    each = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    bounds = np.cumsum([0, *[len(x) + 1 for x in each]])
    data = b" ".join(each).lower()
    hashes, tails, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    for at, piece in _pieces(data):
        found, starts, ends = _piece(piece)
        chars = np.frombuffer(piece, np.uint8)
        before = chars[ends - 2].astype(np.uint16) * (ends - starts > 1)
        hashes.append(found)
        tails.append(before.astype(np.uint16) * np.uint16(256) + chars[ends - 1])
        places.append(starts + at)
    counts = np.diff(np.searchsorted(np.concatenate(places), bounds))
    return np.concatenate(hashes), np.concatenate(tails), counts


def together(texts: Iterable[str | None], size: int = 1 << 17) -> Iterator[list[str | None]]:
    """Consecutive texts in lists of about ``size`` characters, so that their arrays stay in a core's cache."""
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text or "")
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``k``-word shingles; of fewer words, one hash of them all."""
    n = min(len(words), k)
    if not n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        sums += words[j : len(words) - n + 1 + j] * _K[j + 1]
    return np.unique(mixed(sums, n))
