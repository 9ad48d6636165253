"""Token ids of whole texts by a byte-level BPE vocabulary file.

The ids equal those of the ``tokenizers`` library on the same file without added special
tokens; the same vocabulary runs about eight times as fast in ``tiktoken``.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np

#: The splitting pattern of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE files write each byte as one printable letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items() if token not in special
        }
        self.model = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        return self.model.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
