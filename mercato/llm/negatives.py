"""Hard-negative mining with Fagin's threshold algorithm.

Vectors become integers, floor(256 * x) of each component; a row's score for an anchor is the
integer inner product, exact.  Candidates are dealt into blocks of about BLOCK rows of one
label and length; a block holds, for each dimension, the list of its rows sorted by that
component.  An anchor reads the lists of a block side by side: from the largest component on
where its own is positive, from the smallest where it is negative, not at all where it is zero.
Rows met for the first time are scored at random access.  The threshold, the anchor's product
with the components last read, bounds the score of every row not yet met; reading stops once it
falls strictly below the kth best score of each window (or below the window's floor, if that is
higher), so rows that tie with the kth have all been met.  The anchor's depth doubles as it reads.

Two passes: in blocks of its own label an anchor's one window is open at both ends and gives its
positives; in blocks of other labels it has a window [low * p, high * p] for each positive
score p.  The k best of each block are joined by a rank over all blocks, which Spark limits
before the shuffle.  An anchor meets a block in one cell of a grid, blocks by groups of about
CHUNK anchors, so a task's memory is one block and a batch of anchors at any size; blocks of a
hot label are as large as any.

Order: score descending, then id (nulls last), then a hash of the row, then the row's number.
Defined results: rows with a null label, a null vector or any null or non-finite component take
no part; vectors are compared within their length (empty ones score 0); repeated rows are rows
of their own, and "other rows" are all but the anchor's own row; an anchor without positives or
without negatives in a window gives no rows.  Components beyond 2^17 in size raise: up
there products of 64 components would leave the range in which they are exact.  Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .tables import written

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these shares (percent) of its positive's.
LOW, HIGH = 80, 100
BLOCK, CHUNK = 8192, 4096
_FIRST_DEPTH = 16


class Lists:
    """A block's rows and, for each dimension, their order by that component."""

    def __init__(self, u: np.ndarray, x: np.ndarray):
        self.u, self.x = u, x
        self.order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(x.T, self.order, axis=1)
        self.most = int(np.abs(x).max(initial=0))
        self.quick = x.astype(np.float64)

    def scores(self, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
        if self.most * int(np.abs(a).max(initial=0)) * max(1, len(a)) < 1 << 53:  # doubles hold every partial sum
            return (self.quick[rows] @ a.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ a

    def search(self, a: np.ndarray, own: int, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """(window, row, score) of each window's k best rows and all that tie with the last."""
        n = len(self.u)
        dims = np.flatnonzero(a)
        if not len(dims):
            met, score = np.arange(n), np.zeros(n, np.int64)
        else:
            down = a[dims] > 0
            unseen = np.ones(n, bool)
            met, score = np.empty(0, np.int64), np.empty(0, np.int64)
            depth, step = 0, _FIRST_DEPTH
            while depth < n:
                stop = min(n, depth + step)
                read = np.concatenate([self.order[dims[down], n - stop: n - depth].ravel(), self.order[dims[~down], depth: stop].ravel()])
                fresh = np.zeros(n, bool)
                fresh[read] = True
                rows = np.flatnonzero(fresh & unseen)
                unseen[rows] = False
                met, score = np.append(met, rows), np.append(score, self.scores(rows, a))
                at = np.where(down, self.sorted[dims, n - stop], self.sorted[dims, stop - 1])
                threshold = int(a[dims] @ at)
                if all(threshold < self._bar(met, score, own, l, h, k) for l, h in zip(low.tolist(), high.tolist())):
                    break
                depth, step = stop, 2 * step
        for w, (l, h) in enumerate(zip(low.tolist(), high.tolist())):
            bar = self._bar(met, score, own, l, h, k)
            good = (score >= bar) & (score <= h) & (self.u[met] != own)
            for row, s in zip(met[good].tolist(), score[good].tolist()):
                yield w, row, s

    def _bar(self, met: np.ndarray, score: np.ndarray, own: int, low: int, high: int, k: int) -> int:
        """The window's kth best score so far, and its floor as long as there are fewer."""
        inside = score[(score >= low) & (score <= high) & (self.u[met] != own)]
        return max(low, int(np.partition(inside, len(inside) - k)[len(inside) - k])) if len(inside) >= k else low


def _cells(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, anchor or not): first a block's rows, then the anchors that read it."""
    cell, rows, lists = None, [], None
    kinds = [pa.int64()] * 6
    for batch in batches:
        cells, roles, u = (batch.column(c).to_pylist() for c in ("cell", "is_anchor", "u"))
        at = batch.column("x").offsets.to_numpy()
        flat = batch.column("x").values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
        out: list[tuple] = []
        cuts = [r for r in range(1, len(batch)) if cells[r] != cells[r - 1] or roles[r] != roles[r - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(batch)] if len(batch) else []):
            if cells[a] != cell:
                cell, rows, lists = cells[a], [], None
            x = flat[at[a]: at[b]].reshape(b - a, -1) if at[b] > at[a] else np.empty((b - a, 0), np.int64)
            if not roles[a]:
                rows.append((batch.slice(a, b - a).select(["u", "id", "h"]), x))
            elif rows:
                if lists is None:
                    known = pa.Table.from_batches([t for t, _ in rows])
                    ids, tie = known.column("id").to_pylist(), known.column("h").to_pylist()
                    lists = Lists(known.column("u").to_numpy(), np.concatenate([v for _, v in rows]))
                for r in range(a, b):
                    for w, row, score in lists.search(x[r - a], u[r], np.array(low[r]), np.array(high[r]), k):
                        out.append((u[r], w, int(lists.u[row]), ids[row], tie[row], score))
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)],
                                         ["anchor", "w", "u", "id", "h", "score"])


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have at most so many (narrow) rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _best(rows: DataFrame, anchors: DataFrame, same: bool, k: int, block: int, chunk: int) -> DataFrame:
    """anchor, w, id, score, place: the k best rows of each window of each anchor."""
    n_chunks = max(1, -(-anchors.count() // chunk))
    sizes = rows.groupBy("label", "d").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    blocks = (rows.join(_small(sizes, 10_000), ["label", "d"])
              .withColumn("salt", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int")))
    grid = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    place = ["label", "d", "salt", "chunk"]
    windows = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    there = blocks.select("label", "d", "salt", grid.alias("chunk"), F.lit(False).alias("is_anchor"), "u", "id", "h", "x", *windows)
    mine = anchors.withColumn("chunk", F.pmod(F.xxhash64("u", F.lit(1)), F.lit(n_chunks)).cast("int"))
    others = sizes.select(F.col("label").alias("of"), F.col("d").alias("of_d"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"))
    wants = F.col("label") == F.col("of") if same else F.col("label") != F.col("of")
    here = (mine.join(_small(others, 100_000), (F.col("d") == F.col("of_d")) & wants)
            .select(F.col("of").alias("label"), "d", "salt", "chunk", F.lit(True).alias("is_anchor"), "u", "id", "h", "x", "low", "high"))
    met = (there.unionByName(here).withColumn("cell", F.concat_ws("/", *place))
           .repartition(*place).sortWithinPartitions(*place, "is_anchor")
           .select("cell", "is_anchor", "u", "id", "h", "x", "low", "high")
           .mapInArrow(functools.partial(_cells, k=k), "anchor long, w long, u long, id long, h long, score long"))
    near = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "h", "u")
    return met.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k)


def hard_negatives(rows: DataFrame, is_anchor: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: of each row
    that ``is_anchor`` marks and each of its positives, the best rows of other labels that
    score at least ``low`` and at most ``high`` percent of the positive."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    v = F.col("v")
    fine = F.col("label").isNotNull() & F.coalesce(F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    x = F.transform(v, lambda e: F.when(F.abs(e) < float(1 << 17), F.floor(e * 256)).otherwise(F.raise_error(F.lit("a component is beyond 2^17"))))
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    base = written(base.where(fine).select("id", "label", "is_anchor", F.size("v").alias("d"), x.alias("x"), F.xxhash64("v").alias("h"),
                                           F.monotonically_increasing_id().alias("u")), "negative-rows")
    anchors = base.where("is_anchor").select("u", "id", "h", "label", "d", "x")
    every = [F.array(F.lit(bound)).alias(c) for c, bound in (("low", -(1 << 62)), ("high", 1 << 62))]
    good = written(_best(base, anchors.select("*", *every), True, positives, block, chunk)
                   .select("anchor", (F.col("place") - 1).cast("long").alias("w"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "negative-positives")
    down = "((({0}) - pmod({0}, 100L)) div 100)"  # floor({0} / 100)
    floor, ceiling = F.expr("-" + down.format(f"-positive_score * {low}")), F.expr(down.format(f"positive_score * {high}"))
    bounds = (good.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", floor.alias("low"), ceiling.alias("high")))).alias("of"))
              .select(F.col("anchor").alias("u"), F.col("of.low").alias("low"), F.col("of.high").alias("high")))
    bad = _best(base, anchors.join(bounds, "u"), False, negatives, block, chunk)
    return (bad.select("anchor", "w", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(good, ["anchor", "w"]).join(base.where("is_anchor").select(F.col("u").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
