"""Small helpers: tables in the shared folder, checked broadcasts, shuffle files that go in time."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A lookup is broadcast when its rows, written as JSON, take no more than this.
BROADCAST_BYTES = 4 << 20
#: Spark's own setting: the shuffle files of a query are removed when the query ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it was measured to be small; above the bound as it is,
    for a shuffled join whose skew AQE splits.  Give it a checkpointed or written table."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= max_bytes else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has such a column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def tidy(step: Callable) -> Callable:
    """A step (its first argument a frame) whose inner queries leave no shuffle files behind.

    Otherwise those of every finished query stay until the driver happens to collect its garbage,
    so that a step of many joins has all their files on disk at once.  Inside, a frame should be
    executed once (what is used again is checkpointed or written).  The session's setting is put
    back at the end, and a frame that is returned runs under it.
    """
    @functools.wraps(step)
    def run(docs: DataFrame, *args, **kwargs):
        conf = docs.sparkSession.conf
        before = conf.get(TIDY, None)
        conf.set(TIDY, "true")
        try:
            out = step(docs, *args, **kwargs)
        finally:
            conf.unset(TIDY) if before is None else conf.set(TIDY, before)
        return out.select("*") if isinstance(out, DataFrame) else out
    return run
