"""Benchmark decontamination: winnowing fingerprints, joined and extended.

Both sides keep, of every W consecutive K-word grams, the one with the least hash.  With
K + W - 1 equal to the window of 10 words, any 10 words that a document shares with an item
hold W common grams, so both sides keep the same one of them: no shared window is missed.
Items shorter than a window are one window of their own length n; for each such n the
documents post all n-grams (W = 1), so these can't be missed either.

Fingerprints of the benchmark go into a bit table of fixed size that thins the documents'
fingerprints inside the tasks.  What passes is extended to every window around it, and these
windows join the benchmark's windows by an MD5 of their words: the join is exact, the
fingerprints only find places.  Documents without a candidate take no part in any shuffle.

Defined results: null and wordless texts have no words and no hits; items without words have
no windows; repeated items count once per item id; items without an id hit words but are not
counted; repeated documents each get their row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from . import bitmap
from .tables import fresh, lookup
from .words import ALNUM, find_words, gram_hashes, mix, pieces, signed

WINDOW = 10
GRAM = 5


def _winnow(grams: np.ndarray, doc: np.ndarray, k: int, w: int) -> np.ndarray:
    """Places of the grams that are least in one of the runs of w grams inside one text
    (the last of equal ones)."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    runs = np.flatnonzero(doc[:n] == doc[w + k - 2: w + k - 2 + n])
    if not len(runs):
        return runs
    least, at = grams[runs].copy(), runs.copy()
    for j in range(1, w):
        here = grams[runs + j]
        lower = here <= least
        least[lower] = here[lower]
        at[lower] = runs[lower] + j
    return np.unique(at)


def _fingerprints(h: np.ndarray, doc: np.ndarray, n: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes that stand for windows of n words (the full window, or a short item's)."""
    if n < window:
        grams = gram_hashes(h, n)
        at = np.flatnonzero(doc[: len(grams)] == doc[n - 1:][: len(grams)]) if len(grams) else np.empty(0, np.int64)
    else:
        grams = gram_hashes(h, k)
        at = _winnow(grams, doc, k, window - k + 1)
    return at, mix(grams[at] ^ np.uint64(n))


def _window_keys(found, starts: np.ndarray, n: int) -> list[bytes]:
    """MD5 of the words of windows (words are divided by a byte that is in none)."""
    raw = found.data.tobytes()
    out = []
    for s in starts.tolist():
        words = b" ".join(raw[a:b] for a, b in zip(found.starts[s: s + n].tolist(), found.ends[s: s + n].tolist()))
        out.append(hashlib.md5(words, usedforsecurity=False).digest())
    return out


def _items(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in pieces(batch.column(1)):
            found = find_words(texts, ALNUM)
            h, counts = found.hashes(), np.diff(found.bounds)
            ids = batch.column(0).slice(at, len(texts)).to_pylist()
            rows: list[tuple] = []
            for i in np.flatnonzero(counts).tolist():
                a, b = int(found.bounds[i]), int(found.bounds[i + 1])
                n = min(window, b - a)
                spots, prints = _fingerprints(h[a:b], found.doc[a:b], n, window, k)
                starts = np.arange(a, b - n + 1)
                rows += [(ids[i], n, key, None) for key in dict.fromkeys(_window_keys(found, starts, n))]
                rows += [(ids[i], n, None, x) for x in dict.fromkeys(signed(prints).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.int64()))],
                ["item_id", "n", "window", "print"])


def _documents(batches: Iterator[pa.RecordBatch], lengths: list[int], table: bytes, window: int, k: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    hit = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("window", pa.binary())])
    for batch in batches:
        for at, texts in pieces(batch.column(1)):
            found = find_words(texts, ALNUM)
            h = found.hashes()
            maybe: list[list[dict]] = [[] for _ in range(len(texts))]
            for n in lengths:
                spots, prints = _fingerprints(h, found.doc, n, window, k)
                spots = spots[bitmap.test(table, prints)]
                if not len(spots):
                    continue
                if n == window:  # all windows that hold the gram
                    spots = np.unique((spots[:, None] - np.arange(window - k + 1)).ravel())
                    spots = spots[(spots >= 0) & (spots + n <= len(h))]
                    spots = spots[found.doc[spots] == found.doc[spots + n - 1]]
                for d, s, key in zip(found.doc[spots].tolist(), (spots - found.bounds[found.doc[spots]]).tolist(),
                                     _window_keys(found, spots, n)):
                    maybe[d].append({"start": s, "n": n, "window": key})
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + len(texts)), pa.int64()), batch.column(0).slice(at, len(texts)),
                 pa.array(np.diff(found.bounds), pa.int64()), pa.array(maybe, pa.list_(hit))],
                ["uid", "id", "n_words", "maybe"])
            uid += len(texts)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence of an
    item's window), items (sorted ids, as strings, of the items with occurring windows),
    spans (merged hit word ranges [start, end))."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return _contamination(texts, "long", items, item_col, item_text, window, k)


def _contamination(texts: DataFrame, id_type: str, items: DataFrame, item_col: str = "item_id", item_text: str = "text",
                   window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """The same of texts (id, text), whose ids may be of any type."""
    spark = texts.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    known = (items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
             .mapInArrow(functools.partial(_items, window=window, k=k),
                         "item_id long, n int, window binary, print long").checkpoint())
    lengths = [r["n"] for r in known.select("n").distinct().orderBy("n").collect()]  # at most `window` numbers
    table = bitmap.build(known, "print")
    seen = (texts.mapInArrow(functools.partial(_documents, lengths=lengths, table=table, window=window, k=k),
                             f"uid long, id {id_type}, n_words long, maybe array<struct<start int, n int, window binary>>")
            .checkpoint())
    windows = (known.where("window IS NOT NULL").groupBy("window")
               .agg(F.collect_set("item_id").alias("of")).checkpoint())
    places = (seen.where("size(maybe) > 0").select("uid", F.explode("maybe").alias("m"))
              .select("uid", "m.start", "m.n", "m.window"))
    hits = (places.join(windows, "window").groupBy("uid")
            .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("at"),
                 F.array_distinct(F.flatten(F.collect_set("of"))).alias("items")))
    found = hits.select("uid", _merged("at").alias("spans"),
                        F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items"))
    empty = seen.where("size(maybe) = 0").select(
        "id", "n_words", F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    some = seen.where("size(maybe) > 0").select("uid", "id", "n_words").join(found, "uid", "left").select(
        "id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return (empty.unionByName(some)
            .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]))
            .select(F.col("id").alias("doc_id"), "n_words", "n_hit", "items", "spans"))


def _merged(column: str) -> F.Column:
    """Sorted ranges with those that overlap or touch joined into one."""
    def step(done, x):
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                               F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                                                F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end"))))
                      ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.col(column), F.array().cast("array<struct<start:int,end:int>>"), step)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns.  A row's own text
    decides, whatever its id: texts with hits go by their MD5."""
    text = F.col(text_col).cast("string")
    key = F.unhex(F.md5(text.cast("binary")))
    found = _contamination(docs.select(key.alias("id"), text.alias("text")), "binary", items)
    own = fresh(docs, "hit_text")
    bad = found.where("n_hit > 0").select(F.col("doc_id").alias(own)).distinct().checkpoint()
    return docs.join(lookup(bad), key == F.col(own), "left_anti")
