"""Exploratory profiles (N01-N04d): daily volume, gap days, null timestamps by status,
top categories and states, delivery-time summary and histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_delivered
from ..functions.numeric import half_up_div
from .marts import vw_daily_orders
from .star import Star, dim_date_between


def daily_order_volume(star: Star) -> DataFrame:
    """Orders per purchase day, every status (same rows as W4)."""
    return vw_daily_orders(star)


def daily_order_head_tail(star: Star, head: int = 15, tail: int = 20) -> DataFrame:
    """The first ``head`` and last ``tail`` days with orders (two bounded top-k)."""
    daily = vw_daily_orders(star).filter(F.col("orders") > 0)
    # ascending order puts an unknown day last, so the tail starts from it
    first = daily.orderBy(F.asc_nulls_last("order_date")).limit(head).withColumn("part", F.lit("head"))
    last = daily.orderBy(F.desc_nulls_first("order_date")).limit(tail).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


def purchase_date_bounds(star: Star) -> DataFrame:
    """One row: first and last purchase date (the window used when none is given)."""
    return star.fact_orders.agg(F.to_date(F.min("order_purchase_timestamp")).alias("start"),
                                F.to_date(F.max("order_purchase_timestamp")).alias("end"))


def gap_days(star: Star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Calendar days in [start, end] without any order (empty = no gaps).

    The calendar spine is generated from a one-row bounds frame; the distinct order days
    are an aggregate, so the anti join compares days with days.
    """
    if start and end:
        bounds = star.fact_orders.sparkSession.range(1).select(
            F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end"))
    else:
        bounds = purchase_date_bounds(star)
    spine = dim_date_between(bounds).select(F.col("date").alias("calendar_day"))
    days = star.fact_orders.select(F.to_date("order_purchase_timestamp").alias("calendar_day")).distinct()
    return spine.join(days, "calendar_day", "left_anti")


def nulls_by_status(star: Star) -> DataFrame:
    """Per status the order count and NULL counts of three lifecycle timestamps."""
    return star.fact_orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("order_approved_at").isNull()).alias("null_approved_at"),
        F.count_if(F.col("order_delivered_carrier_date").isNull()).alias("null_delivered_carrier"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("null_delivered_customer"))


def category_item_counts(star: Star, top: int = 15) -> DataFrame:
    """Top categories by item lines, all statuses, missing category as 'unknown'.

    Items are counted per product first, so the product join moves one row per product.
    """
    per_product = star.fact_order_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    cat = (per_product.join(star.dim_products.select("product_id", "product_category_name_english"),
                            "product_id")
           .groupBy(F.coalesce("product_category_name_english", F.lit("unknown")).alias("category"))
           .agg(F.sum("n").alias("items")))
    return cat.orderBy(F.desc_nulls_first("items"), F.asc_nulls_last("category")).limit(top)


def state_person_counts(star: Star, top: int = 10) -> DataFrame:
    """Top states by distinct persons."""
    st = star.dim_customers.groupBy("customer_state").agg(
        F.count_distinct("customer_unique_id").alias("customers"))
    return st.orderBy(F.desc_nulls_first("customers"), F.asc_nulls_last("customer_state")).limit(top)


def _describe(df: DataFrame, col: str, by: str | None = None, scale: int = 6) -> DataFrame:
    """count, mean, sample sd, min, quartiles (linear interpolation, exact), max."""
    c = F.col(col)
    aggs = [F.count(c).alias("count"),
            half_up_div(F.sum(c), F.count(c), scale).alias("mean"),
            F.round(F.stddev_samp(c), scale).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.percentile(c, 0.25).alias("q25"),
            F.percentile(c, 0.5).alias("q50"),
            F.percentile(c, 0.75).alias("q75"),
            F.max(c).cast("double").alias("max")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def delivered_delivery_days(star: Star) -> DataFrame:
    return star.fact_orders.filter(is_delivered() & F.col("delivery_days").isNotNull()).select("delivery_days")


def delivery_days_summary(star: Star) -> DataFrame:
    """describe() of delivery_days over delivered orders (exact quartiles)."""
    return _describe(delivered_delivery_days(star), "delivery_days")


def delivery_days_histogram(star: Star, bins: int = 40) -> DataFrame:
    """N04d: equal-width bins between min and max, the last bin closed on the right.

    Bin edges come from a one-row min/max aggregate joined to every row.  The bin of a
    value is floor((v - lo) * bins / span); for integer day counts the one double division
    lands on the exact quotient.
    """
    d = delivered_delivery_days(star)
    mm = d.agg(F.min("delivery_days").alias("_lo"), F.max("delivery_days").alias("_hi"))
    lo, hi, v = F.col("_lo"), F.col("_hi"), F.col("delivery_days")
    span = hi - lo
    idx = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) * F.lit(bins) / F.when(span == 0, 1).otherwise(span)), F.lit(bins - 1)))
    binned = d.crossJoin(F.broadcast(mm)).select(idx.cast("int").alias("bin"), "_lo", "_hi")
    width = (F.col("_hi") - F.col("_lo")).cast("double") / F.lit(float(bins))
    return (binned.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("orders"))
            .select("bin",
                    (F.col("_lo") + width * F.col("bin")).alias("bin_start"),
                    (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_end"),
                    "orders"))
