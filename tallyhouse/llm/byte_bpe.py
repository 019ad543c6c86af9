"""Ids of a byte-level vocabulary: by ranks where that works, else by the vocabulary's library.

The rank file of a vocabulary has the ids of its JSON file and is encoded with four
times as quickly, but by a pattern whose engine ends the process on very long runs
of white space; a text with such a run goes to the library of the JSON file.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Mapping
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"
# The engine gives up on some 700,000; a run is looked for in texts that could hold one.
LONG_RUN = 10_000
_LONG = re.compile(rf"\s{{{LONG_RUN}}}")


@lru_cache(maxsize=2)
def _ranks(vocabulary: str) -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def special_tokens(vocabulary: str) -> dict[str, int]:
    """The special tokens that the vocabulary's own file has."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"] if x["special"]}


@lru_cache(maxsize=2)
def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of each id; special tokens, whose strings are no bytes of a text, have none."""
    ranks = _ranks(vocabulary)
    last = max([*ranks.values(), *special_tokens(vocabulary).values()])
    known = {rank: token for token, rank in ranks.items()}
    return [known.get(i, b"") for i in range(last + 1)]


@lru_cache(maxsize=2)
def _library(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


class Encoder:
    """Text to ids. The strings of `special` have ids of their own, wherever they stand."""

    def __init__(self, vocabulary: str = VOCABULARY, special: Mapping[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary
        self.special = dict(special or {})
        self._by_ranks = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(vocabulary),
            special_tokens=self.special,
        )
        names = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self._cut = re.compile(f"({names})") if names else None

    def __call__(self, text: str) -> list[int]:
        if len(text) >= LONG_RUN and _LONG.search(text):
            return self._by_library(text)
        if any(name in text for name in self.special):
            return self._by_ranks.encode(text, allowed_special="all")
        return self._by_ranks.encode_ordinary(text)

    def _by_library(self, text: str) -> list[int]:
        """Special tokens part a text before anything else does, so its parts are encoded alone."""
        ids: list[int] = []
        for part in self._cut.split(text) if self._cut else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += _library(self.vocabulary).encode(part, add_special_tokens=False).ids
        return ids


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The vocabulary as its library has it, special tokens included."""
    return Encoder(vocabulary, special_tokens(vocabulary))


@lru_cache(maxsize=4)
def plain_encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The strings of special tokens are plain text."""
    return Encoder(vocabulary)


def lengths(vocabulary: str = VOCABULARY) -> np.ndarray:
    """Bytes of each id."""
    return np.array([len(token) for token in token_bytes(vocabulary)], np.int64)
