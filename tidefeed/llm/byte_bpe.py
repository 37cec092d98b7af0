"""Token ids of whole texts by a byte-level BPE file."""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken


def default_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin bytes as they are and the rest from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """The vocabulary of a tokenizers file, run by the faster of the two libraries that read it.

    The strings of special tokens in a text are ordinary text.
    """

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model["added_tokens"]}
        of = _byte_of_character()
        ranks = {
            bytes(of[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }
        self.coder = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        #: Bytes of text that each id stands for.
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.bytes_of[number] = len(token)

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.coder.encode_to_numpy(text, disallowed_special=()), np.uint32)


@cache
def encoder(file: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(file)
