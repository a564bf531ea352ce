"""Late delivery versus review score (N11-N13): grouped description, one-sided
Mann-Whitney U test with tie correction, and effect sizes.

The rank-sum test never sorts rows: rows are counted per (value, group), the running
count of rows below each distinct value gives every value its mid-rank, and the test
needs only sums over those counts.  The running count uses ``global_cumsum``, so even a
high-cardinality value column is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up_div, pct
from ..functions.ranking import global_cumsum
from .analysis import reviewed_delivered
from .eda import _describe
from .star import Star


def late_review_describe(star: Star) -> DataFrame:
    """describe() of review_score per lateness value."""
    return _describe(reviewed_delivered(star), "review_score", by="is_late")


def rank_sum_parts(df: DataFrame, value_col: str, group_col: str) -> DataFrame:
    """One row: n1 (group true), n2 (group false), twice the rank sum of group true
    (an integer), and the tie term sum(t^3 - t)."""
    counts = df.filter(F.col(value_col).isNotNull() & F.col(group_col).isNotNull()).groupBy(value_col).agg(
        F.count_if(F.col(group_col)).alias("_n1"),
        F.count_if(~F.col(group_col)).alias("_n2"))
    counts = counts.withColumn("_t", F.col("_n1") + F.col("_n2"))
    cum = global_cumsum(counts, [F.col(value_col).asc()], F.col("_t"), out_col="_upto")
    before = F.col("_upto") - F.col("_t")
    twice_rank = (before * 2 + F.col("_t") + 1).cast("decimal(38,0)")
    return cum.agg(
        F.coalesce(F.sum("_n1"), F.lit(0)).alias("n1"),
        F.coalesce(F.sum("_n2"), F.lit(0)).alias("n2"),
        F.coalesce(F.sum(F.col("_n1").cast("decimal(38,0)") * twice_rank), F.lit(0)).alias("r1x2"),
        F.coalesce(F.sum(F.col("_t").cast("decimal(38,0)") * F.col("_t") * F.col("_t") - F.col("_t")),
                   F.lit(0)).alias("ties"))


def mann_whitney_u(star: Star) -> DataFrame:
    """N12 (statistic): U of the late group, group sizes and the continuity-corrected
    normal score z = (U - n1*n2/2 + 1/2) / sd, sd corrected for ties.  NULL z when a
    group is empty or the variance is zero."""
    return mann_whitney_from_parts(rank_sum_parts(reviewed_delivered(star), "review_score", "is_late"))


def mann_whitney_from_parts(parts: DataFrame) -> DataFrame:
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = (F.col("r1x2") - F.col("n1").cast("decimal(38,0)") * (F.col("n1") + 1)).cast("double") / F.lit(2.0)
    var = n1 * n2 / F.lit(12.0) * ((n + F.lit(1.0)) - F.col("ties").cast("double") / (n * (n - F.lit(1.0))))
    z = F.when((n1 > 0) & (n2 > 0) & (var > 0),
               (u1 - n1 * n2 / F.lit(2.0) + F.lit(0.5)) / F.sqrt(var))
    return parts.select(F.col("n1").alias("n_late"), F.col("n2").alias("n_on_time"),
                        u1.alias("u_statistic"), F.round(z, 9).alias("z"))


#: Coefficients of the published Chebyshev fit of erfc (relative error below 1.2e-7).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
        -0.82215223, 0.17087277)


def erfc(x: Column) -> Column:
    """Complementary error function of a column."""
    t = F.lit(1.0) / (F.lit(1.0) + F.abs(x) * F.lit(0.5))
    poly = F.lit(0.0)
    for c in reversed(ERFC):
        poly = poly * t + F.lit(c)
    tail = t * F.exp(poly - x * x)
    return F.when(x < 0, F.lit(2.0) - tail).otherwise(tail)


def mann_whitney_pvalue(star: Star) -> DataFrame:
    """N12 (test): one-sided p-value that late scores are stochastically lower,
    p = Phi(z) = erfc(-z / sqrt 2) / 2; NULL where z is."""
    stat = mann_whitney_u(star).withColumn("_x", -F.col("z") / F.lit(2.0 ** 0.5))
    return stat.select("n_late", "n_on_time", "u_statistic", "z",
                       F.when(F.col("z").isNotNull(), erfc(F.col("_x")) / F.lit(2.0)).alias("p_value"))


def review_effect_size(star: Star) -> DataFrame:
    """Per lateness value n, mean and median (3dp) and % of 1-2 star scores (2dp)."""
    return reviewed_delivered(star).groupBy("is_late").agg(
        F.count(F.lit(1)).alias("n"),
        half_up_div(F.sum("review_score"), F.count("review_score"), 3).alias("mean"),
        F.round(F.percentile("review_score", 0.5), 3).alias("median"),
        pct(F.count_if(F.col("review_score") <= 2), F.count(F.lit(1))).alias("pct_1_2_star"))
