"""Ids of whole texts by the public tokenizer files, and the bytes behind every id."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken

from chronomart.llm.bpe import byte_symbols

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Fixed value: how a piece of one byte is written.
ONE_BYTE = re.compile("<0x([0-9A-F]{2})>")


class ByteBpe:
    """A byte-level BPE file of the tokenizers library, encoded by tiktoken at about four times its speed.

    Ids of merged tokens ascend with the merges, so a token's rank is its id. A test
    compares both libraries over characters, whole tokens and repeated letters.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbol = byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(symbol[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.bytes: list[bytes] = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.bytes[i] = token

    def encode(self, text: str) -> np.ndarray:
        """As the library's ``encode(text, add_special_tokens=False)``: special tokens in the text are found."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def encode_plain(self, text: str) -> np.ndarray:
        """The strings of special tokens are text like any other."""
        return self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


class PieceBpe:
    """A sentencepiece file with byte fallback."""

    def __init__(self, path: str) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        found = [ONE_BYTE.fullmatch(p) for p in pieces]
        self.bytes = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(pieces, found)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)
