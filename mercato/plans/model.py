"""The staged tables plus the star built on them, as one lazily evaluated bundle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import Star, build_star
from ..sources import csv as csv_source
from ..sources import testdata


@dataclass
class Model:
    stg: dict[str, DataFrame]
    star: Star


def from_staging(stg: dict[str, DataFrame]) -> Model:
    return Model(stg=stg, star=build_star(stg))


def from_testdata(spark: SparkSession, sf_dir: str) -> Model:
    """Model over the driver's parquet test tables (the binding in sources.testdata)."""
    return from_staging(testdata.staging_tables(spark, sf_dir))


def from_csv(spark: SparkSession, raw_dir: str, file_map: dict[str, str] | None = None,
             out_dir: str | None = None) -> Model:
    """Model over the nine source CSV files (text staging, then typed star)."""
    frames, _ = csv_source.stage_all(spark, raw_dir, file_map, out_dir)
    return from_staging(frames)
