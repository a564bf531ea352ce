"""Vectorised words and hashes over Arrow string columns (numpy, used inside tasks).

A batch of texts is worked on as one byte array: word boundaries come from a byte table,
and every word's 64-bit hash comes from prefix sums of a polynomial, so no Python string
is made per word.  Texts are cut into pieces of about ``PIECE`` bytes (one text at least),
which bounds the memory of a task whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: ``[^\x20\x09-\x0D]+``: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Letters only (ASCII letters and every byte of a non-ASCII character).
LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        for name, base in (("p", _P), ("inv", _P_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            table = np.multiply.accumulate(steps)
            if size > 4 * PIECE:  # a very long text: use once, don't keep
                _POWERS.pop(name, None)
                if name == "p":
                    p = table
                else:
                    return p, table
            else:
                _POWERS[name] = table
    return _POWERS["p"], _POWERS["inv"]


@dataclass
class Words:
    """Words of a piece: ``data`` its (lower-cased) bytes, ``starts``/``ends`` byte spans,
    ``doc`` the text (position in the piece) that each word is in, ``bounds`` word range of
    each text, ``sums`` the prefix sums behind the hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        _, inv = _powers(len(self.sums))
        raw = (self.sums[ends] - self.sums[starts]) * inv[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _Q)

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def prefix_hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the words longer than n bytes: which they are, and hashes of their first n bytes."""
        which = np.flatnonzero(self.ends - self.starts > n)
        starts = self.starts[which]
        return which, self.span_hash(starts, starts + n)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and the offsets of its texts (null: no bytes)."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, pa.Array]]:
    """The array in slices of about ``size`` bytes; each with its first row's position."""
    if not len(texts):
        return
    _, at = text_bytes(texts)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        yield start, texts.slice(start, stop - start)
        start = stop


def find_words(texts: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    """Words of the texts: longest runs of the bytes that ``table`` marks."""
    raw, at = text_bytes(texts)
    data = LOWER[raw] if lower else raw
    inside = table[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    power, _ = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return Words(data, starts, ends, doc, bounds, sums)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive word hashes (by place; texts are not told apart)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    weight = 1
    for j in range(k):
        out += h[j: j + n] * np.uint64(weight)
        weight = weight * int(_Q) % (1 << 64)
    return mix(out ^ np.uint64(k))


def shingles(texts: pa.Array, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text (white-space words, A-Z lowered);
    a text of fewer words has its whole sequence as one.  Also each text's word count."""
    found = find_words(texts, NOT_SPACE)
    h = found.hashes()
    grams = gram_hashes(h, k)
    out = []
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if b - a >= k:
            s = np.sort(grams[a: b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(gram_hashes(h[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out, np.diff(found.bounds)


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark longs."""
    return h.view(np.int64)
