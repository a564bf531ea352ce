"""The whole batch run: stage, input gate, star, output gate, publish, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import Star
from ..sources import csv as csv_source
from . import catalog, snapshots


def read_star(spark: SparkSession, root: str) -> Star:
    """The star that was last published below ``root``."""
    return snapshots.read_star(spark, root)


def run_pipeline(spark: SparkSession, raw_dir: str, out_dir: str, file_map: dict[str, str] | None = None,
                 database: str | None = None) -> tuple[Star, DataFrame, DataFrame]:
    """Stage the source files into a new snapshot below ``out_dir``, gate, build and publish it
    there (``snapshots.publish_gated``); with ``database``, remake the catalog views over it.

    A failed gate raises and leaves the pointer, and the views, on the earlier snapshot.
    """
    snapshot = snapshots.new_snapshot(out_dir)
    stg, _ = csv_source.stage_all(spark, raw_dir, file_map, f"{snapshot}/staging")
    published = snapshots.publish_gated(spark, stg, out_dir, snapshot)
    if database:
        catalog.remake_views(spark, out_dir, database)
    return published
