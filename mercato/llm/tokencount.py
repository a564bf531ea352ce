"""Edit-aware token counts: segment trees over pre-tokens.

A document's text is cut into pre-tokens, runs of RUN of them are the leaves of a binary tree
(an array: node i has the children 2i and 2i + 1, the root is 1), and every node keeps the
characters and tokens below it.  An edit descends by characters to the leaves it touches.
Only those, one leaf of context before them, and as much behind as it takes until a
pre-token boundary falls on an old leaf boundary again are pre-tokenised and counted anew;
from that boundary on the old pre-tokens hold, since pre-tokenising goes from left to right.
The new pre-tokens are spread over the same leaves and only the sums above them change; a
document whose leaves have grown far beyond RUN gets a new tree.

Trees are columns of a table, so edits can come at any later time, joined by id.

Defined results: a null or empty text has a tree of one empty leaf and 0 tokens; edits are
[start, end) character ranges of the text before any of them, they must not overlap, are cut
to the text, and those at one place apply in their order; edits of unknown documents are
ignored; documents without edits keep their tree.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .tokens import Pieces, load, pieces_of
from .words import pieces as slices

RUN = 32
#: A leaf that holds so many times RUN pre-tokens makes the tree be built anew.
GROWN = 8
#: The production edit pass: what is masked, and by what.
MASKS = ((regex.compile(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<email>"),
         (regex.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])"), "<address>"),
         (regex.compile(r"(?<![\d-])\+?\d[\d() -]{7,}\d(?![\d-])"), "<phone>"))


class Tree:
    """Sums of characters and tokens over the leaves."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << max(0, (len(chars) - 1).bit_length())
        out = []
        for leaves in (chars, tokens):
            nodes = np.zeros(2 * size, np.int64)
            nodes[size: size + len(leaves)] = leaves
            level = size
            while level > 1:
                nodes[level // 2: level] = nodes[level: 2 * level: 2] + nodes[level + 1: 2 * level: 2]
                level //= 2
            out.append(nodes)
        return cls(*out)

    @classmethod
    def build(cls, text: str, coder: Pieces) -> Tree:
        split = coder.split(text)
        chars = [sum(map(len, split[i: i + RUN])) for i in range(0, len(split), RUN)] or [0]
        tokens = [sum(map(coder.count, split[i: i + RUN])) for i in range(0, len(split), RUN)] or [0]
        return cls.of_leaves(chars, tokens)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character (the last leaf with characters, at the end), and its first character."""
        node, before = 1, 0
        at = min(at, max(0, int(self.chars[1]) - 1))
        while node < self.size:
            node *= 2
            if at >= before + self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node - self.size, before

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        for nodes, value in ((self.chars, chars), (self.tokens, tokens)):
            node = leaf + self.size
            change = value - nodes[node]
            while node and change:
                nodes[node] += change
                node //= 2

    def apply(self, text: str, edits: list[tuple[int, int, str]], coder: Pieces) -> tuple[Tree, str, int]:
        """The tree and text after the edits, and how many characters were encoded anew."""
        tree, again = self, 0
        for start, end, new in reversed(sorted(enumerate_edits(edits, len(text)))):
            tree, text, seen = tree._one(text, start, end, new, coder)
            again += seen
        return tree, text, again

    def _one(self, text: str, start: int, end: int, new: str, coder: Pieces) -> tuple[Tree, str, int]:
        low, first = self.find(max(0, start - 1))
        if low:  # a leaf of context
            low, first = self.find(max(0, first - 1))
        high, at = self.find(max(start, end - 1))
        stop = at + int(self.chars[self.size + high])
        text = text[:start] + new + text[end:]
        moved = len(new) - (end - start)
        total = int(self.chars[1])
        while True:
            ahead = stop  # where the characters end that must be seen to judge `stop`
            if stop < total:
                leaf, at = self.find(stop)
                ahead = at + int(self.chars[self.size + leaf])
            split = coder.split(text[first: ahead + moved])
            length, n = 0, 0
            while n < len(split) and length < stop + moved - first:
                length += len(split[n])
                n += 1
            if length == stop + moved - first and (n < len(split) or ahead >= total):
                break
            if stop >= total:
                break
            high, stop = leaf, ahead
        split = split[:n]
        leaves = high - low + 1
        if len(split) > GROWN * RUN * leaves or (high - low) * 2 > max(4, self.size):
            return Tree.build(text, coder), text, len(text)
        per = -(-len(split) // leaves)
        for k in range(leaves):
            part = split[k * per: (k + 1) * per]
            self.set(low + k, sum(map(len, part)), sum(map(coder.count, part)))
        return self, text, sum(map(len, split))


def enumerate_edits(edits: list[tuple[int, int, str]], length: int) -> list[tuple[int, int, str]]:
    """Edits cut to the text, those at one place as one."""
    out: list[tuple[int, int, str]] = []
    for start, end, new in sorted(((max(0, min(s, length)), max(0, min(max(s, e), length)), n or "") for s, e, n in edits),
                                  key=lambda x: x[:2]):
        if out and out[-1][1] > start:
            raise ValueError(f"edits overlap at {start}")
        if out and out[-1][0] == start:
            out[-1] = (start, end, out[-1][2] + new)
        else:
            out.append((start, end, new))
    return out


def masks(text: str) -> list[tuple[int, int, str]]:
    """The production edits of a text: personal data replaced by its kind."""
    found, end = [], 0
    for start, stop, new in sorted((m.start(), m.end(), new) for pattern, new in MASKS for m in pattern.finditer(text)):
        if start >= end:
            found.append((start, stop, new))
            end = stop
    return found


_EDIT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])
EDITS = "array<struct<start long, end long, text string>>"


def _build(batches: Iterator[pa.RecordBatch], vocabulary: bytes, mask: bool) -> Iterator[pa.RecordBatch]:
    coder = pieces_of(vocabulary)
    for batch in batches:
        for at, texts in slices(batch.column(1)):
            ids, edits = batch.column(0).slice(at, len(texts)), []
            trees = []
            for text in texts.to_pylist():
                trees.append(Tree.build(text or "", coder))
                edits.append([{"start": s, "end": e, "text": n} for s, e, n in masks(text or "")] if mask else None)
            yield pa.RecordBatch.from_arrays(
                [ids, texts, pa.array([t.chars for t in trees], pa.list_(pa.int64())), pa.array([t.tokens for t in trees], pa.list_(pa.int64())),
                 pa.array(edits, pa.list_(_EDIT))], ["id", "text", "chars", "tokens", "edits"])


def _apply(batches: Iterator[pa.RecordBatch], vocabulary: bytes, keep: bool) -> Iterator[pa.RecordBatch]:
    coder = pieces_of(vocabulary)
    for batch in batches:
        for at, texts in slices(batch.column(1)):
            n = len(texts)
            chars, tokens, edits = (batch.column(c).slice(at, n) for c in (2, 3, 4))
            rows = []
            for i, text in enumerate(texts.to_pylist()):
                todo = [(e["start"], e["end"], e["text"]) for e in edits[i].as_py() or []]
                before = tokens[i].values[1].as_py() if tokens[i].is_valid else 0
                if not todo:
                    rows.append((text, chars[i].as_py(), tokens[i].as_py(), before, 0, before, 0) if keep else
                                (None, None, None, before, 0, before, 0))
                    continue
                tree = Tree(np.array(chars[i].values), np.array(tokens[i].values))
                tree, text, again = tree.apply(text or "", todo, coder)
                rows.append((text if keep else None, tree.chars if keep else None, tree.tokens if keep else None, before, len(todo),
                             int(tree.tokens[1]), again))
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, n), *(pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds))],
                ["id", "text", "chars", "tokens", "n_tokens", "n_edits", "n_tokens_after", "chars_encoded"])


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: bool = False, vocabulary: bytes | None = None) -> DataFrame:
    """id, text, chars, tokens (the trees) and edits (the production masks, with ``mask``)."""
    ensure_checkpoint_dir(docs.sparkSession)
    ship_package(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(functools.partial(_build, vocabulary=vocabulary or load(), mask=mask),
                        f"id long, text string, chars array<long>, tokens array<long>, edits {EDITS}"))


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with the edits (id, start, end, text) of each document; one document's edits are
    a list, bounded by its text."""
    lists = edits.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "text"))).cast(EDITS).alias("edits"))
    return trees.drop("edits").join(lists, "id", "left").select("id", "text", "chars", "tokens", "edits")


def apply_edits(trees: DataFrame, keep: bool = True, vocabulary: bytes | None = None) -> DataFrame:
    """The documents after their edits: id, text, chars, tokens (null without ``keep``),
    n_tokens (before), n_edits, n_tokens_after, chars_encoded."""
    return trees.mapInArrow(functools.partial(_apply, vocabulary=vocabulary or load(), keep=keep),
                            "id long, text string, chars array<long>, tokens array<long>, n_tokens long, n_edits long, "
                            "n_tokens_after long, chars_encoded long")
