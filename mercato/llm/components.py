"""Connected components by local contraction, in Spark joins.

Each round every vertex takes the neighbour (or itself) of least random priority, edges are
rewritten to those vertices, and loops and repeats go; the number of edges falls by a
constant factor a round, also on long chains.  Once no more than FEW edges are left, a number
that doesn't grow with the input, a single task contracts these.  Nothing is collected; a round's tables are
written to the shared folder and read again, which cuts the lineage and gives the planner
their true sizes (estimates carried through checkpoints multiply with every round's joins).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import written

#: Edges (16 bytes each) that are left to one task; as long as there are more, rounds of joins thin them.
FEW = 1 << 16


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex in ``edges`` (a, b longs); the root is one of its vertices.

    Loops, repeats and nulls are ignored; no edges give no rows.
    """
    left = written(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    turn = 0
    while (n := left.count()) > FEW:
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("rank"), F.col(c).alias("id"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hop = _hop(both, rank)
        labels = _followed(labels, hop)
        left = written(left.join(hop.select(F.col("v").alias("a"), F.col("to").alias("x")), "a")
                       .join(hop.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
                       .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), "edges")
        turn += 1
    if n:
        ship_package(edges.sparkSession)
        labels = _followed(labels, written(left.coalesce(1).mapInArrow(_contract, "v long, to long"), "hops"))
    return labels if labels is not None else left.select(F.col("a").alias("v"), F.col("b").alias("root"))


def _followed(labels: DataFrame | None, hop: DataFrame) -> DataFrame:
    if labels is None:
        return hop.select("v", F.col("to").alias("root"))
    return written(labels.join(hop.withColumnRenamed("v", "root"), "root", "left")
                   .select("v", F.coalesce("to", "root").alias("root")), "labels")


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vertex of at most FEW edges with the least vertex of its component."""
    ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not ends:
        return
    ids, at = np.unique(np.concatenate([e[k] for k in (0, 1) for e in ends]), return_inverse=True)
    a, b = np.split(at, 2)
    root, before = np.arange(len(ids)), None
    while before is None or (root != before).any():
        before = root
        low = np.minimum(root[a], root[b])
        root = root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], ["v", "to"])


def _hop(both: DataFrame, rank) -> DataFrame:
    return written(both.groupBy("a").agg(F.min(rank("b")).alias("least"))
                   .select(F.col("a").alias("v"),
                           F.when(F.col("least") < rank("a"), F.col("least").getField("id"))
                           .otherwise(F.col("a")).alias("to")), "hops")
