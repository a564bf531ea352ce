"""Embedding near-dedup with randomised-rotation binary codes.

A vector, scaled to length 1 and turned by a random rotation R, is coded by the signs of its
coordinates; with the code goes its correction factor f, the inner product of the turned
vector and its scaled code.  For another turned vector q, <code, q> / (sqrt(d) f) is an
unbiased estimate of the cosine, and its error exceeds
EPS * sqrt((1 - f^2) / f^2) / sqrt(d - 1) with negligible probability (EPS = 5: below 1e-6).
Estimate plus bound below the threshold rejects a pair; every other pair is computed again in
double precision, and only that decides.

Pairs are estimated inside cells.  Sign bits of further rotations, BITS at a time, are the
keys of TABLES tables; two vectors at angle a agree in a bit with probability 1 - a/pi.
BITS grows with the logarithm of the number of vectors, so that cells keep their size, and
TABLES is taken so that a pair exactly at the threshold misses all tables with probability
below MISS (more similar pairs far less).  Keys held by many vectors, such as a group of near
copies, are cut into blocks and dealt out as block pairs, so no task gets more than two
blocks; per vector a cell returns its number of links and one edge into its cell's tree, so
rows out are as many as rows in, never one per pair.  A pair that meets in several tables is
counted in the first.

Equal vectors are one class with a multiplicity.  Vectors are compared within their length.
Defined results: null, empty and zero vectors and those with a null or non-finite component
link with nothing; repeated rows count as copies; a null id is never a smallest id.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .components import connected_components

COSINE = 0.95
MISS = 1e-4
EPS = 5.0
#: Vectors a key should hold on average, and vectors in a block of a key that holds more.
CELL, BLOCK = 800, 1024


@functools.cache
def rotation(d: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    rng = np.random.default_rng([d, number, 77])
    q, r = np.linalg.qr(rng.standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def plan(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = max(1, min(30, round(math.log2(max(2.0, n / CELL)))))
    agree = 1 - math.acos(cosine) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree ** bits)))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / scale
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def table_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Keys (n, tables) of unit vectors."""
    d = x.shape[1]
    need = bits * tables
    signs = np.concatenate([x @ rotation(d, 1 + i).T > 0 for i in range(-(-need // d))], axis=1)[:, :need]
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    return flat, lengths


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length in a list array."""
    flat, lengths = _matrix(column)
    at = np.concatenate(([0], np.cumsum(lengths)))
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[at[rows][:, None] + np.arange(d)]


def _post(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """A row per class and table: d, tab, key, v."""
    for batch in batches:
        for rows, x in _by_length(batch.column(1)):
            keys = table_keys(_unit(x), bits, tables)
            v = batch.column(0).to_numpy()[rows]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n * tables, x.shape[1], np.int32)), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                 pa.array(keys.ravel()), pa.array(np.repeat(v, tables)),
                 pa.array(np.repeat(batch.column(2).to_numpy()[rows], tables)), batch.column(1).take(pa.array(np.repeat(rows, tables)))],
                ["d", "tab", "key", "v", "copies", "x"])


def _tree(link: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix: the least place reachable from each place."""
    label = np.arange(len(link))
    while True:
        least = np.minimum(label, np.where(link, label[None, :], len(link)).min(axis=1))
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _meet(x: np.ndarray, first: int, cosine: float) -> np.ndarray:
    """Link matrix of a cell: all places, or (first >= 0) places before ``first`` with those from it on."""
    unit = _unit(x)
    d = x.shape[1]
    turned = (unit @ rotation(d, 0).T).astype(np.float32)
    code = np.where(turned > 0, np.float32(1), np.float32(-1))
    f = np.maximum((np.abs(turned).sum(axis=1) / math.sqrt(d)).astype(np.float64), 1e-6)
    bound = EPS * np.sqrt(np.maximum(0, 1 - f * f)) / f / math.sqrt(max(1, d - 1)) + 1e-4
    a, b = (slice(None), slice(None)) if first < 0 else (slice(0, first), slice(first, None))
    estimate = (turned[a] @ code[b].T) / (math.sqrt(d) * f[b].astype(np.float32))
    i, j = np.nonzero(estimate >= (cosine - bound[b]).astype(np.float32)[None, :])
    j = j + max(0, first)
    keep = i < j
    i, j = i[keep], j[keep]
    link = np.zeros((len(x), len(x)), bool)
    for at in range(0, len(i), 1 << 16):  # again, in double precision
        p, q = i[at: at + (1 << 16)], j[at: at + (1 << 16)]
        good = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
        link[p[good], q[good]] = True
    link |= link.T
    return link


def _cells(batches: Iterator[pa.RecordBatch], bits: int, tables: int, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (d, tab, key, low, high, block, v, copies, x) -> (v, links, other)."""
    held: list[pa.RecordBatch] = []

    def cell(rows: pa.Table) -> pa.RecordBatch | None:
        tab, low, high = (rows.column(c)[0].as_py() for c in ("tab", "low", "high"))
        block, v, copies = (rows.column(c).to_numpy() for c in ("block", "v", "copies"))
        order = np.lexsort((v, block))
        flat, lengths = _matrix(rows.column("x").combine_chunks())
        x = flat.reshape(len(v), int(lengths[0]))[order]
        v, copies = v[order], copies[order]
        first = -1 if low == high else int((block == low).sum())
        link = _meet(x, first, cosine)
        if not link.any():
            return None
        tree = _tree(link)
        new = link
        if tab:  # counted in the first table where the two meet
            p, q = np.nonzero(link)
            keys = table_keys(_unit(x), bits, tables)[:, :tab]
            for at in range(0, len(p), 1 << 16):
                s, e = p[at: at + (1 << 16)], q[at: at + (1 << 16)]
                seen = (keys[s] == keys[e]).any(axis=1)
                new[s[seen], e[seen]] = False
        some = np.flatnonzero((tree != np.arange(len(v))) | new.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(v[some]), pa.array((new @ copies)[some]), pa.array(v[tree[some]])],
                                          ["v", "links", "other"])

    def done() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        if len(rows) > 1:
            out = cell(rows)
            if out is not None:
                yield out

    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(5)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(batch)] if len(batch) else []
        for a, b in zip(edges[:-1], edges[1:]):
            now = tuple(keys[a].tolist())
            if held and now != last:
                yield from done()
                held.clear()
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield from done()


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 miss: float = MISS) -> DataFrame:
    """One row per row: vec_id, n_links (other rows linked directly), component_id (smallest
    id reachable, its own where there is none), kept."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    x = F.col("x")
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
                      & F.exists(x, lambda e: e != 0), F.lit(False))
    base = base.select("id", fine.alias("fine"), F.when(fine, x).alias("x"), F.monotonically_increasing_id().alias("u"),
                       F.xxhash64("x").alias("h1"), F.hash("x").alias("h2"), F.size("x").alias("d")).checkpoint()
    same = ["d", "h1", "h2"]
    classes = (base.where("fine").groupBy(*same).agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
               .checkpoint())
    one = classes.join(base.select(F.col("u").alias("v"), "x"), "v").select("v", "x", "copies").checkpoint()
    bits, tables = plan(one.count(), cosine, miss)
    posts = one.mapInArrow(functools.partial(_post, bits=bits, tables=tables),
                           "d int, tab int, key long, v long, copies long, x array<double>")
    held = (one.select("v", "x", "copies").mapInArrow(functools.partial(_post_keys, bits=bits, tables=tables), "d int, tab int, key long")
            .groupBy("d", "tab", "key").count().where("count > 1").checkpoint())
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    dealt = (posts.join(held.withColumn("blocks", blocks).drop("count"), ["d", "tab", "key"])
             .withColumn("block", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("d", "tab", "key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
                     "block", "v", "copies", "x"))
    cell = ["d", "tab", "key", "low", "high"]
    found = (dealt.repartition(*cell).sortWithinPartitions(*cell)
             .mapInArrow(functools.partial(_cells, bits=bits, tables=tables, cosine=cosine), "v long, links long, other long")
             .checkpoint())
    links = found.groupBy("v").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("v").alias("a"), F.col("other").alias("b")))
    known = classes.join(links, "v", "left").join(roots, "v", "left").checkpoint()
    least = known.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("group")).checkpoint()
    known = known.join(least, "root", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("group", "least").alias("component")
    ).withColumn("ok", F.lit(True)).checkpoint()
    out = (base.select("id", "fine", *same).join(known, [*(base[c] == known[c] for c in same), base["fine"] == known["ok"]], "left")
           .select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component", "id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _post_keys(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """How the class vectors fall on keys, without the vectors."""
    for posted in _post(batches, bits, tables):
        yield posted.select(["d", "tab", "key"])
