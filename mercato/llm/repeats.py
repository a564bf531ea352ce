"""Substring dedup by seed and extend: winnowed anchors, joined, extended both ways.

Seeds.  Of every WINDOW consecutive words the K-word gram of least hash (the last of equal
ones) is the window's anchor; equal windows have equal anchors at the same place, so no shared
window is missed.  Neighbouring windows mostly share their anchor: a text keeps an anchor for
each (WINDOW - K) / 2 words or so.

Extension.  The windows of one anchor are consecutive; together they form its block, the
anchor extended both ways as far as windows around it reach.  Blocks are compared first, by a
128-bit hash of their words: where a block occurs in a text of a smaller id, all its windows
do.  What is left are first occurrences of blocks.  An anchor with blocks that differ is
contested: there the extension agrees only in part, so the windows of its distinct blocks (one
copy each, however often a block occurs) are compared one by one, by 128-bit hashes too.  Words
covered by a hit window join into maximal repeats, spans of WINDOW words or more.

Copies cost one row per block and copy, never a pair; all groups are reduced by aggregates
that combine before they shuffle, and what joins back to occurrences is one row per block, so
a passage in a third of all texts leaves one hot key on the long side of a join, which
adaptive execution splits.  Texts are shuffled twice, packed; intermediate tables are written
to the shared folder.

Order: a text's id; a null id counts as the greatest long.  Defined results: null and wordless
texts have no words; texts shorter than WINDOW keep all; texts with the same id don't remove
words of each other (their ids are not smaller); repeats inside one text stay; windows are
judged on the input, not on what is left.  Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .tables import written
from .words import NOT_SPACE, PIECE, find_words, gram_hashes, mix, pieces, signed

WINDOW, GRAM = 50, 20
_LAST = (1 << 63) - 1
# Odd multipliers of the two hashes of a word sequence.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """For each run of w grams the place of the least one (the last of equal ones)."""
    at = np.arange(len(grams))
    have = 1
    while have < w:  # least of `have` grams from each place; doubled, the last time with overlap
        step = min(have, w - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(grams[right] <= grams[left], right, left)
        have += step
    return at


def _sequence_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the word sequences starts .. ends-1, as longs."""
    out = []
    n = (ends - starts).astype(np.uint64)
    for m in _MULTIPLIERS:
        power = np.full(len(h) + 1, m, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h + np.uint64(m)) * power[:-1], out=sums[1:])
        inverse = np.full(len(h) + 1, pow(m, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        out.append(signed(mix((sums[ends] - sums[starts]) * inverse[starts] + n * np.uint64(m ^ 0xFF))))
    return out[0], out[1]


def _blocks(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (u, id, o, text) -> u, id, o, the text packed, its blocks (anchor, h1, h2, first window, windows)."""
    pack = zstandard.ZstdCompressor(level=1).compress
    kind = pa.struct([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])
    for batch in batches:
        for row, texts in pieces(batch.column(3)):
            found = find_words(texts, NOT_SPACE, lower=False)
            h = found.hashes()
            # windows by their first word; they must end in the text that they start in
            s = np.arange(max(0, len(h) - window + 1))
            s = s[found.doc[s] == found.doc[s + window - 1]]
            grams = gram_hashes(h, k)
            at = _anchors(grams, window - k + 1)[s]
            new = np.ones(len(s), bool)
            new[1:] = (np.diff(at) != 0) | (np.diff(s) != 1)
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(s)))
            h1, h2 = _sequence_hashes(h, s[first], s[first] + n + window - 1)
            doc = found.doc[s[first]]
            flat = pa.StructArray.from_arrays(
                [pa.array(signed(grams[at[first]])), pa.array(h1), pa.array(h2),
                 pa.array((s[first] - found.bounds[doc]).astype(np.int32)), pa.array(n.astype(np.int32))], fields=list(kind))
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(row, len(texts)) for c in range(3)),
                 pa.array([pack((text.as_py() or "").encode()) for text in texts], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(cuts), flat)], ["u", "id", "o", "packed", "blocks"])


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows (text, o, wanted blocks (h1, h2, s, n)) -> a row per window: h1, h2, j, o, w1, w2."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row, packed in pieces(batch.column(0), PIECE // 4):
            texts = pa.array([unpack(x.as_py()) for x in packed], pa.large_binary())
            found = find_words(texts, NOT_SPACE, lower=False)
            lists = batch.column(2).slice(row, len(texts))
            flat = lists.flatten()
            h1, h2, s, n = (flat.field(x).to_numpy() for x in range(4))
            doc = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
            block = np.repeat(np.arange(len(s)), n)
            j = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
            starts = (found.bounds[doc] + s)[block] + j
            w1, w2 = _sequence_hashes(found.hashes(), starts, starts + window)
            o = batch.column(1).slice(row, len(texts)).to_numpy()[doc[block]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h1[block], h2[block], j.astype(np.int32), o, w1, w2)], ["h1", "h2", "j", "o", "w1", "w2"])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, packed text, hits (s, n, mask)) -> doc_id, n_words, spans, kept."""
    unpack = zstandard.ZstdDecompressor().decompress
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        out: list[tuple] = []
        for doc_id, packed, hits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            words = unpack(packed.as_py()).split()  # bytes are split at ASCII white space alone
            spans: list[dict] = []
            if hits.is_valid:
                edge = np.zeros(len(words) + 1, np.int64)
                for hit in hits.as_py():
                    at = np.arange(hit["n"]) + hit["s"]
                    if hit["mask"] is not None:
                        at = at[np.isin(np.arange(hit["n"]), hit["mask"])]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                inside = np.concatenate(([False], np.cumsum(edge)[:-1] > 0, [False]))
                turn = np.flatnonzero(inside[1:] != inside[:-1])
                spans = [{"start": a, "end": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())]
                rest, last = [], 0
                for x in spans:
                    rest += words[last: x["start"]]
                    last = x["end"]
                kept = b" ".join(rest + words[last:])
            else:
                kept = b" ".join(words)
            out.append((doc_id, len(words), spans, kept.decode()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.list_(span), pa.string()))],
            ["doc_id", "n_words", "spans", "kept"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """One row per row: doc_id, n_words, spans (word ranges [start, end) of the repeats that
    went, maximal), kept (the other words, joined by one space)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    base = written(docs.select(
        F.monotonically_increasing_id().alias("u"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("o"), F.col(text_col).cast("string").alias("text")).mapInArrow(
            functools.partial(_blocks, window=window, k=k),
            "u long, id long, o long, packed binary, blocks array<struct<anchor:long,h1:long,h2:long,s:int,n:int>>"), "repeat-blocks")
    places = base.select("u", "o", F.inline("blocks"))
    distinct = written(places.groupBy("h1", "h2").agg(
        F.min(F.struct("o", "u", "s")).alias("first"), F.max("o").alias("last"),
        F.first("anchor").alias("anchor"), F.first("n").alias("n")), "repeat-distinct")
    contested = (distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("first.o").alias("low"), F.max("first.o").alias("high"))
                 .where("kinds > 1 AND low < high").select("anchor"))
    wanted = (distinct.join(contested, "anchor").groupBy("first.u")
              .agg(F.collect_list(F.struct("h1", "h2", "first.s", "n")).alias("wanted")))  # at most a text's own blocks
    windows = written(base.join(wanted, "u").select("packed", "o", "wanted").mapInArrow(
        functools.partial(_windows, window=window), "h1 long, h2 long, j int, o long, w1 long, w2 long"), "repeat-windows")
    earliest = (windows.groupBy("w1", "w2").agg(F.min("o").alias("low"), F.max("o").alias("high"))
                .where("low < high").drop("high"))
    partly = (windows.join(earliest, ["w1", "w2"]).where("low < o").groupBy("h1", "h2")
              .agg(F.sort_array(F.collect_set("j")).alias("mask")))  # at most a block's windows
    hot = written(distinct.join(partly, ["h1", "h2"], "left").where("last > first.o OR mask IS NOT NULL")
                  .select("h1", "h2", F.col("first.o").alias("first"), "mask"), "repeat-hits")
    hits = (places.join(hot, ["h1", "h2"]).where("o > first OR mask IS NOT NULL").groupBy("u")
            .agg(F.collect_list(F.struct("s", "n", F.when(F.col("o") == F.col("first"), F.col("mask")).alias("mask"))).alias("hits")))
    return base.join(hits, "u", "left").select("id", "packed", "hits").mapInArrow(
        functools.partial(_cut, window=window),
        "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string")
