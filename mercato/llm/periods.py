"""Periodic run detection: recursive frequency splitting, then a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least max(LEAST, TIMES * q) long, that no neighbouring word extends keeping period q.

Each word of a run comes at least TIMES times in it.  So a word that comes fewer than TIMES
times in its segment (a whole text at first) is in no run there: it splits the segment, pieces
shorter than LEAST go, and the pieces are counted again, until no segment holds a rare word.
All texts of a piece are split together; only segments that changed are counted again.

What survives is scanned by lags, k = 1, 2, 4, ... at a time for the lags above k/2 up to k:
grams of k words get numbers (pairs of the numbers of half the size, so equality is exact),
and the lag of a place is the distance to the nearest earlier equal gram in its segment.  A
gram at least q long repeats inside a run of smallest period q at distance q and no less, so
every run shows as one island of places with the same lag q, and an island of b - a + 1 places
is the stretch of words a - q .. b + k - 1, which has smallest period q.  A lag needs segments
of TIMES * q words, so the scan ends after log2(n / TIMES) sizes: n log^2 n work a text.

Texts are rows of their own, so nothing is shuffled and nothing grows but with one text.
Words are told apart by a 64-bit hash.  Defined results: null, empty and wordless texts have
no words, no runs and an empty collapsed text; a text shorter than LEAST has no runs; repeated
rows and null ids each get their row; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .words import NOT_SPACE, find_words, pieces

LEAST, TIMES = 24, 3


def _segments(at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Numbers of the stretches of consecutive places inside one text."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])
    return np.cumsum(new) - 1


def survivors(word: np.ndarray, doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Places left when no segment is short or holds a word fewer than ``times`` times."""
    at, stable = np.arange(len(word)), []
    kinds = int(word.max()) + 1 if len(word) else 1
    while len(at):
        seg = _segments(at, doc)
        long = np.bincount(seg)[seg] >= least
        at, seg = at[long], seg[long]
        _, which, count = np.unique(seg * kinds + word[at], return_inverse=True, return_counts=True)
        rare = count[which] < times
        changed = np.zeros(int(seg[-1]) + 1 if len(seg) else 0, bool)
        changed[seg[rare]] = True
        stable.append(at[~changed[seg]])
        at = at[changed[seg] & ~rare]
    return np.sort(np.concatenate(stable)) if stable else at


def lag_scan(word: np.ndarray, doc: np.ndarray, at: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs (start, length, period) in the segments that the places ``at`` form, by start and period."""
    seg = _segments(at, doc)
    size = np.bincount(seg) if len(seg) else np.empty(0, np.int64)
    stop = np.cumsum(size)[seg]
    gram = seg * (int(word.max()) + 1 if len(word) else 1) + word[at]
    i, k, found = np.arange(len(at)), 1, [np.empty((0, 3), np.int64)]
    while len(i):
        order = np.argsort(gram[i], kind="stable")
        here = gram[i][order]
        same = here[1:] == here[:-1]
        lag = np.zeros(len(i), np.int64)
        lag[order[1:][same]] = (i[order[1:]] - i[order[:-1]])[same]
        numbers = np.empty(len(i), np.int64)
        numbers[order] = np.concatenate(([0], np.cumsum(~same)))
        gram = gram.copy()
        gram[i] = numbers
        good = np.flatnonzero((2 * lag > k) & (lag <= k))
        if len(good):
            step = (np.diff(i[good]) != 1) | (np.diff(lag[good]) != 0) | (np.diff(seg[i[good]]) != 0)
            first, last = good[np.concatenate(([True], step))], good[np.concatenate((step, [True]))]
            q = lag[first]
            runs = np.stack([at[i[first]] - q, i[last] - i[first] + k + q, q], 1)
            found.append(runs[runs[:, 1] >= np.maximum(least, times * q)])
        i = i[(i + 2 * k <= stop[i]) & (size[seg[i]] >= max(least, times * (k + 1)))]
        pair = gram[i] * (len(gram) + 1) + gram[i + k]
        gram[i] = pair
        k *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _texts(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, texts in pieces(batch.column(1)):
            found = find_words(texts, NOT_SPACE, lower=False)
            word = np.unique(found.hashes(), return_inverse=True)[1].astype(np.int64)
            runs = lag_scan(word, found.doc, survivors(word, found.doc, least, times), least, times)
            edge = np.zeros(len(word) + 1, np.int64)
            np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
            dropped = np.cumsum(edge[:-1]) > 0
            doc = found.doc[runs[:, 0]]
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            flat = pa.StructArray.from_arrays([pa.array(runs[:, 0] - found.bounds[doc]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                                              fields=list(_RUN))
            kept = []
            for d, text in enumerate(texts):
                words = (text.as_py() or "").encode().split()  # bytes are split at ASCII white space alone
                if cuts[d] < cuts[d + 1]:
                    gone = dropped[found.bounds[d]: found.bounds[d + 1]]
                    words = [words[j] for j in np.flatnonzero(~gone).tolist()]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)), pa.array(np.diff(found.bounds)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), flat), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  times: int = TIMES) -> DataFrame:
    """One row per row: doc_id, n_words, runs (start, length, period; by start, then period) and
    collapsed: the words, joined by one space, without those that any run holds after its
    first period."""
    ensure_checkpoint_dir(docs.sparkSession)
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        functools.partial(_texts, least=least, times=times),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs: str = "runs") -> F.Column:
    """The run with the greatest length/period (compared exactly; ties: smallest start, then
    smallest period); null if there is none."""
    def better(best, x):
        a, b = x["length"] * best["period"], best["length"] * x["period"]
        return F.when(best.isNull() | (a > b), x).otherwise(best)  # runs come by start, then period
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
