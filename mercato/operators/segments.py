"""Retention matrix and rule-based RFM segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cents, frequency_bucket, from_cents, segment_label
from ..functions.numeric import pct
from ..functions.tiles import qcut_positions, tile_columns
from .analysis import PERSON, cohort_retention, rfm_base
from .star import Star


def cohort_pct_matrix(star: Star, cohorts: DataFrame | None = None) -> DataFrame:
    """% of each cohort's offset-0 size active at each month offset (2dp), in long form:
    one row per cohort and offset with activity, whatever the number of offsets."""
    long = cohorts if cohorts is not None else cohort_retention(star)
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort"))
    return (long.withColumn("cohort_size", size)
            .select("cohort", "cohort_size", "month_offset",
                    pct(F.col("active_customers"), F.col("cohort_size")).alias("active_pct")))


def rfm_person_base(star: Star) -> DataFrame:
    """Last order date, distinct delivered orders and revenue per person."""
    return rfm_base(star)


def rfm_segments(star: Star, tiles: int = 5, base: DataFrame | None = None) -> DataFrame:
    """Recency quantile bin of the first-occurrence rank (ties by person id),
    frequency bucket 1/2/3+ and the business segment label."""
    base = base if base is not None else rfm_base(star)
    r = tile_columns(base, PERSON, {"r": (F.unix_date("last_order"), lambda n: qcut_positions(n, tiles))})["r"]
    f = frequency_bucket(F.col("frequency"))
    return (base.select("customer_unique_id", "last_order", "frequency", "monetary", r.alias("r_score"), f.alias("f_bucket"))
            .withColumn("segment", segment_label(F.col("f_bucket"), F.col("r_score"))))


def segment_summary(star: Star, segments: DataFrame | None = None) -> DataFrame:
    """Persons, revenue and both shares (2dp) per segment (four rows at most)."""
    seg = segments if segments is not None else rfm_segments(star)
    agg = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                     F.sum(cents("monetary")).alias("revenue"))
    everything = Window.partitionBy()  # four rows at most
    return agg.select(
        "segment", "customers", from_cents("revenue").alias("revenue"),
        pct(F.col("revenue"), F.sum("revenue").over(everything)).alias("revenue_share_pct"),
        pct(F.col("customers"), F.sum("customers").over(everything)).alias("customer_share_pct"))
