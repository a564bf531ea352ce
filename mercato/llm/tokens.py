"""A public byte-level BPE vocabulary: pre-tokens, their ids and counts, cached by task.

The vocabulary file is a parameter; the driver reads it and its bytes go to the tasks (fixed
size).  Pre-tokens repeat, so a task encodes each distinct one once.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import regex
import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: End of text; the id is free in the vocabulary.
END = 50256
_CACHE = 400_000


def load(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """Pre-tokens and their ids."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.coder = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN).findall
        self._ids: dict[str, bytes] = {}

    def ids(self, piece: str) -> bytes:
        """A pre-token's ids as little-endian 16-bit numbers."""
        got = self._ids.get(piece)
        if got is None:
            if len(self._ids) >= _CACHE:
                self._ids.clear()
            got = self._ids[piece] = np.array(self.coder.encode_ordinary(piece), "<u2").tobytes()
        return got

    def count(self, piece: str) -> int:
        return len(self.ids(piece)) >> 1

    def encode(self, text: str) -> bytes:
        """A whole text's ids: the same as those of its pre-tokens, one after the other."""
        return np.array(self.coder.encode_ordinary(text), "<u2").tobytes()


@functools.lru_cache(maxsize=2)
def pieces_of(vocabulary: bytes) -> Pieces:
    return Pieces(vocabulary)
