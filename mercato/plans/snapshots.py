"""Snapshots of the star: every build has a folder of its own, readers follow a pointer.

Below a root: ``snapshots/<id>/star/<table>`` (and ``staging``), and ``published``, a table of
(version, snapshot) that a publish appends one row to.  The greatest version is the pointer.
A one-row append becomes visible when its single file is renamed into place, so a reader finds
the earlier star or the new one, whole, on any store Spark can write; a build that fails, or is
lost on its way, leaves a folder that nothing points to.  One publisher at a time per root.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.star import STAR_TABLES, Star, build_star, publish_star
from ..sources.csv import path_is_missing

_LOG_SCHEMA = "version long, snapshot string, published_at timestamp"


class NoSnapshotError(LookupError):
    pass


def publish_log(spark: SparkSession, root: str) -> DataFrame:
    """(version, snapshot, published_at) of every publish below ``root``."""
    try:
        return spark.read.schema(_LOG_SCHEMA).json(f"{root.rstrip('/')}/published")
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], _LOG_SCHEMA)


def _latest(spark: SparkSession, root: str):
    return publish_log(spark, root).orderBy(F.desc("version"), F.desc("snapshot")).first()


def current(spark: SparkSession, root: str) -> str:
    """Folder of the published snapshot; NoSnapshotError before the first publish."""
    latest = _latest(spark, root)
    if latest is None:
        raise NoSnapshotError(f"nothing was published below {root}")
    return f"{root.rstrip('/')}/snapshots/{latest['snapshot']}"


def new_snapshot(root: str) -> str:
    """Path of a snapshot folder that nothing points to yet."""
    return f"{root.rstrip('/')}/snapshots/{uuid.uuid4().hex}"


def point_to(spark: SparkSession, root: str, snapshot: str) -> int:
    """Switch the pointer to a snapshot folder of ``root``; the new version."""
    latest = _latest(spark, root)
    version = 1 if latest is None else latest["version"] + 1
    (spark.range(1).coalesce(1)
     .select(F.lit(version).cast("long").alias("version"), F.lit(snapshot.rstrip("/").rsplit("/", 1)[1]).alias("snapshot"),
             F.current_timestamp().alias("published_at"))
     .write.mode("append").json(f"{root.rstrip('/')}/published"))
    return version


def read_star(spark: SparkSession, root: str) -> Star:
    """The published star."""
    return star_at(spark, current(spark, root))


def star_at(spark: SparkSession, snapshot: str) -> Star:
    """The star of one snapshot.  fact_orders without its partition column; ``by_month`` keeps it."""
    star = Star({})
    for name in STAR_TABLES:
        table = spark.read.parquet(f"{snapshot.rstrip('/')}/star/{name}")
        if name == "fact_orders":
            star.by_month = table
            table = table.drop("purchase_month")
        star.bind(name, table)
    return star


def publish_built(spark: SparkSession, stg: Mapping[str, DataFrame], root: str, snapshot: str | None = None) -> tuple[Star, DataFrame]:
    """Build the star into a snapshot, gate it as read back, and only then point to it.

    Raises QualityGateError on a blocking row; the published star is then still the earlier one.
    Returns the star and the output gate's report.
    """
    snapshot = snapshot or new_snapshot(root)
    publish_star(build_star(stg), f"{snapshot}/star")
    star = star_at(spark, snapshot)
    after = quality.gate_output(star, stg)
    point_to(spark, root, snapshot)
    return star, after


def publish_gated(spark: SparkSession, stg: Mapping[str, DataFrame], root: str,
                  snapshot: str | None = None) -> tuple[Star, DataFrame, DataFrame]:
    """The input gate over the staged tables, then ``publish_built``.  Nothing is built
    after a failed input gate.  Returns the star and both gates' reports."""
    before = quality.gate_input(stg)
    star, after = publish_built(spark, stg, root, snapshot)
    return star, before, after
