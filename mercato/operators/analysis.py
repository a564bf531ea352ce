"""Business-question queries (A01-A19) over the typed star.

Population rules: revenue, retention, RFM and delivery questions use delivered orders;
the status funnel uses every placed order (R2).  Item lines are summed per order (or per
order and product/seller) before they meet the orders table, so the join moves one row
per order instead of one per line.  Windows without PARTITION BY only ever run over
already-aggregated rows (months, states, categories, ten sellers); person-level tiles are
found by selection, without a sort (``tile_columns``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (CANCELED, cents, frequency_bucket, from_cents, is_delivered,
                                 line_revenue_cents, month_start, months_between_starts)
from ..functions.numeric import half_up_div, pct
from ..functions.tiles import ntile_positions, tile_columns
from ..session import scratch_path
from .star import Star



def _all() -> Window:
    """Whole-frame window; used on aggregated rows only."""
    return Window.partitionBy()


def order_revenue(star: Star) -> DataFrame:
    """(order_id, order_revenue): item revenue per order in cents, all orders with items."""
    if star.order_revenue is not None:
        return star.order_revenue
    return (star.fact_order_items.groupBy("order_id")
            .agg(F.sum(line_revenue_cents()).alias("order_revenue")))


def delivered_orders(star: Star, *cols: str) -> DataFrame:
    return star.fact_orders.filter(is_delivered()).select("order_id", *cols)


def delivered_order_revenue(star: Star, *cols: str) -> DataFrame:
    """Delivered orders with their item revenue (orders without items drop out)."""
    return delivered_orders(star, *cols).join(order_revenue(star), "order_id")


def monthly_revenue_mom(star: Star) -> DataFrame:
    """Revenue per month and growth against the previous month present."""
    monthly = (delivered_order_revenue(star, "order_purchase_timestamp")
               .groupBy(month_start("order_purchase_timestamp").alias("month"))
               .agg(F.sum("order_revenue").alias("revenue")))
    lagged = monthly.withColumn("_prev", F.lag("revenue").over(Window.orderBy("month")))
    return lagged.select(
        "month", from_cents("revenue").alias("revenue"),
        half_up_div((F.col("revenue") - F.col("_prev")) * F.lit(100), F.col("_prev"), 1)
        .alias("mom_growth_pct"),
    )


def aov_trend(star: Star) -> DataFrame:
    """Orders and average order value per month."""
    # one row per (month, order) first - the rows are already partitioned by order_id, so
    # this needs no shuffle - then a plain count per month is the distinct order count
    per_order = (delivered_order_revenue(star, "order_purchase_timestamp")
                 .groupBy(month_start("order_purchase_timestamp").alias("month"), "order_id")
                 .agg(F.sum("order_revenue").alias("order_revenue")))
    monthly = per_order.groupBy("month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_revenue").alias("revenue"))
    return monthly.select("month", "orders",
                          half_up_div(F.col("revenue"), F.col("orders") * F.lit(100), 2)
                          .alias("aov"))


def category_pareto(star: Star) -> DataFrame:
    """Revenue by category with share and cumulative share.  The cumulative sum uses
    a RANGE frame, so categories with equal revenue share one cumulative value."""
    lines = star.fact_order_items.join(delivered_orders(star), "order_id")
    per_product = lines.groupBy("product_id").agg(F.sum(line_revenue_cents()).alias("revenue"))
    cat = (per_product.join(star.dim_products.select("product_id", "product_category_name_english"),
                            "product_id")
           .groupBy(F.coalesce("product_category_name_english", F.lit("unknown")).alias("category"))
           .agg(F.sum("revenue").alias("revenue")))
    running = Window.orderBy(F.desc_nulls_first("revenue")).rangeBetween(Window.unboundedPreceding,
                                                             Window.currentRow)
    total = F.sum("revenue").over(_all())
    return cat.select(
        "category", from_cents("revenue").alias("revenue"),
        pct(F.col("revenue"), total).alias("revenue_share_pct"),
        pct(F.sum("revenue").over(running), total).alias("cumulative_share_pct"),
    )


def revenue_by_state(star: Star) -> DataFrame:
    """Distinct orders, revenue and revenue share per customer state."""
    per_order = delivered_order_revenue(star, "customer_id")
    by_order = (per_order.join(star.dim_customers.select("customer_id", "customer_state"), "customer_id")
                .groupBy(F.col("customer_state").alias("state"), "order_id")
                .agg(F.sum("order_revenue").alias("order_revenue")))
    st = by_order.groupBy("state").agg(F.count(F.lit(1)).alias("orders"),
                                       F.sum("order_revenue").alias("revenue"))
    return st.select("state", "orders", from_cents("revenue").alias("revenue"),
                     pct(F.col("revenue"), F.sum("revenue").over(_all())).alias("revenue_share_pct"))


def payment_mix(star: Star) -> DataFrame:
    """Payment records, share, mean installments and value per payment type (all
    payment records)."""
    mix = star.order_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payment_records"),
        F.sum("payment_installments").alias("_inst"),
        F.count("payment_installments").alias("_inst_n"),
        F.sum(cents("payment_value")).alias("total_payment_value"))
    return mix.select(
        "payment_type", "payment_records",
        pct(F.col("payment_records"), F.sum("payment_records").over(_all())).alias("share_pct"),
        half_up_div(F.col("_inst"), F.col("_inst_n"), 2).alias("avg_installments"),
        from_cents("total_payment_value").alias("total_payment_value"))


def seller_revenue(star: Star) -> DataFrame:
    lines = star.fact_order_items.join(delivered_orders(star), "order_id")
    return lines.groupBy("seller_id").agg(F.sum(line_revenue_cents()).alias("revenue"))


def seller_concentration(star: Star, top: int = 10) -> DataFrame:
    """Top sellers by revenue with rank and cumulative share of all revenue.

    The total is a global aggregate (one row) and the top-k a bounded TakeOrdered, so no
    window ever sees every seller.  Equal revenues rank by seller_id.
    """
    sellers = seller_revenue(star)
    total = sellers.agg(F.sum("revenue").alias("_total"))
    # descending sorts put NULL first and ascending ones last, as the SQL model does
    top_rows = sellers.orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("seller_id")).limit(top)
    order = Window.orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("seller_id"))
    ranked = top_rows.select("seller_id", "revenue", F.row_number().over(order).alias("revenue_rank"))
    running = Window.orderBy("revenue_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.crossJoin(F.broadcast(total)).select(
        "seller_id", from_cents("revenue").alias("revenue"), "revenue_rank",
        pct(F.sum("revenue").over(running), F.col("_total")).alias("cumulative_share_pct"))


def order_status_funnel(star: Star) -> DataFrame:
    """Orders and share per status, all placed orders."""
    f = star.fact_orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    return f.select("order_status", "orders",
                    pct(F.col("orders"), F.sum("orders").over(_all())).alias("share_pct"))


def delivery_days_distribution(star: Star) -> DataFrame:
    """Exact histogram of delivery_days over delivered orders."""
    return (star.fact_orders.filter(is_delivered() & F.col("delivery_days").isNotNull())
            .groupBy("delivery_days").agg(F.count(F.lit(1)).alias("orders")))


def _late_counts(df: DataFrame, key) -> DataFrame:
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias("delivered_orders"),
                              F.count_if(F.col("is_late")).alias("late_orders"))
    return agg.withColumn("late_pct", pct(F.col("late_orders"), F.col("delivered_orders")))


def late_pct_by_month(star: Star) -> DataFrame:
    """Late share per purchase month; orders with unknown lateness stay in the
    denominator."""
    d = star.fact_orders.filter(is_delivered())
    return _late_counts(d, month_start("order_purchase_timestamp").alias("month"))


def late_pct_by_state(star: Star, min_orders: int = 30) -> DataFrame:
    """A10: late share per customer state, states with at least ``min_orders``."""
    d = (star.fact_orders.filter(is_delivered()).select("customer_id", "is_late")
         .join(star.dim_customers.select("customer_id", "customer_state"), "customer_id"))
    out = _late_counts(d, F.col("customer_state").alias("state"))
    return out.filter(F.col("delivered_orders") >= min_orders)


def reviewed_delivered(star: Star) -> DataFrame:
    """(order_id, is_late, review_score) for delivered orders with known lateness."""
    o = star.fact_orders.filter(is_delivered() & F.col("is_late").isNotNull()).select("order_id", "is_late")
    return o.join(star.order_reviews.select("order_id", "review_score"), "order_id")


def late_vs_review(star: Star) -> DataFrame:
    """Per lateness value: reviewed orders, mean, median and % of 1-2 star scores."""
    return reviewed_delivered(star).groupBy("is_late").agg(
        F.count(F.lit(1)).alias("reviewed_orders"),
        half_up_div(F.sum("review_score"), F.count("review_score"), 2).alias("avg_review_score"),
        F.percentile("review_score", 0.5).alias("median_review_score"),
        pct(F.count_if(F.col("review_score") <= 2), F.count(F.lit(1))).alias("pct_1_2_star"))


def delivered_person_orders(star: Star) -> DataFrame:
    """(customer_unique_id, order_id, order_purchase_timestamp) of delivered orders."""
    o = delivered_orders(star, "customer_id", "order_purchase_timestamp")
    return o.join(star.dim_customers.select("customer_id", "customer_unique_id"), "customer_id")


def cohort_retention(star: Star) -> DataFrame:
    """Active persons per (first-purchase month, months since then).

    The distinct (person, month) set is formed first; it holds at most one row per person
    and calendar month, so the per-person window that finds the cohort stays small even
    for a person with a very large share of orders.
    """
    activity = (delivered_person_orders(star)
                .select("customer_unique_id",
                        month_start("order_purchase_timestamp").alias("activity_month"))
                .distinct())
    cohort = F.min("activity_month").over(Window.partitionBy("customer_unique_id"))
    tagged = activity.select("customer_unique_id", "activity_month", cohort.alias("cohort"))
    # (person, month) is distinct and the cohort is a function of the person, so each
    # person appears once per (cohort, offset): a plain count is the distinct count
    return (tagged.groupBy("cohort", months_between_starts(F.col("activity_month"), F.col("cohort"))
                           .alias("month_offset"))
            .agg(F.count(F.lit(1)).alias("active_customers")))


def repeat_purchase_rate(star: Star) -> DataFrame:
    """Persons, persons with two or more delivered orders, and their share."""
    per_person = (delivered_person_orders(star).groupBy("customer_unique_id")
                  .agg(F.count_distinct("order_id").alias("delivered_orders")))
    agg = per_person.agg(F.count(F.lit(1)).alias("total_customers"),
                         F.count_if(F.col("delivered_orders") >= 2).alias("repeat_customers"))
    return agg.select("total_customers", "repeat_customers",
                      pct(F.col("repeat_customers"), F.col("total_customers")).alias("repeat_pct"))


def rfm_base(star: Star) -> DataFrame:
    """N06 / A14 base: last order date, distinct delivered orders and revenue per person
    (orders without items drop out)."""
    per_order = delivered_order_revenue(star, "customer_id", "order_purchase_timestamp")
    joined = per_order.join(star.dim_customers.select("customer_id", "customer_unique_id"),
                            "customer_id")
    return joined.groupBy("customer_unique_id").agg(
        F.to_date(F.max("order_purchase_timestamp")).alias("last_order"),
        F.count_distinct("order_id").alias("frequency"),
        from_cents(F.sum("order_revenue")).alias("monetary"))


PERSON = "customer_unique_id"


def _recency() -> Column:
    return F.unix_date("last_order")


def _ntile(tiles: int):
    return lambda n: ntile_positions(n, tiles)


def recency_scored(base: DataFrame, tiles: int = 5) -> DataFrame:
    """``base`` plus r_score: NTILE over the last order date, ties broken by person id."""
    return base.withColumns(tile_columns(base, PERSON, {"r_score": (_recency(), _ntile(tiles))}))


def rfm_scores(star: Star, tiles: int = 5, base: DataFrame | None = None) -> DataFrame:
    """Recency NTILE by last order, frequency bucket 1/2/3+, monetary NTILE; ties in
    either sort key are broken by the person id."""
    base = base if base is not None else rfm_base(star)
    score = tile_columns(base, PERSON, {"r_score": (_recency(), _ntile(tiles)), "m_score": (cents("monetary"), _ntile(tiles))})
    return base.select(PERSON, score["r_score"].alias("r_score"), frequency_bucket(F.col("frequency")).alias("f_bucket"),
                       score["m_score"].alias("m_score"))


def rfm_segment_share(star: Star, tiles: int = 5, base: DataFrame | None = None) -> DataFrame:
    """Persons, revenue and revenue share per (r_score, f_bucket)."""
    base = base if base is not None else rfm_base(star)
    scored = recency_scored(base, tiles).withColumn("f_bucket", frequency_bucket(F.col("frequency")))
    seg = scored.groupBy("r_score", "f_bucket").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(cents("monetary")).alias("segment_revenue"))
    return seg.select("r_score", "f_bucket", "customers",
                      from_cents("segment_revenue").alias("segment_revenue"),
                      pct(F.col("segment_revenue"), F.sum("segment_revenue").over(_all()))
                      .alias("revenue_share_pct"))


def items_vs_payments(star: Star, tolerance: float = 0.01) -> DataFrame:
    """Orders whose item total and payment total differ by more than the tolerance.

    Both sides are summed per order before the joins (no items x payments fan-out); the
    three inputs then meet on the same key, so they share one partitioning.
    """
    items = star.fact_order_items.groupBy("order_id").agg(F.sum(line_revenue_cents()).alias("_items"))
    pays = star.order_payments.groupBy("order_id").agg(F.sum(cents("payment_value")).alias("_pays"))
    j = star.fact_orders.select("order_id").join(items, "order_id").join(pays, "order_id")
    diff = F.col("_pays") - F.col("_items")
    tol_cents = int(round(tolerance * 100))
    return (j.filter(F.abs(diff) > F.lit(tol_cents))
            .select("order_id", from_cents("_items").alias("item_total"),
                    from_cents("_pays").alias("payment_total"), from_cents(diff).alias("diff")))


def duplicate_review_orders(stg_reviews: DataFrame) -> DataFrame:
    """Number of orders with more than one raw review."""
    dup = stg_reviews.groupBy("order_id").count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("orders_with_multiple_reviews"))


def temporal_violation_counts(orders: DataFrame) -> DataFrame:
    """The three impossible timestamp orderings, one aggregate pass."""
    ts = {c: F.col(c).cast("timestamp_ntz") for c in (
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")}
    return orders.agg(
        F.count_if(ts["order_delivered_carrier_date"] < ts["order_approved_at"])
        .alias("carrier_before_approved"),
        F.count_if(ts["order_delivered_customer_date"] < ts["order_delivered_carrier_date"])
        .alias("customer_before_carrier"),
        F.count_if((F.col("order_status") == CANCELED)
                   & F.col("order_delivered_customer_date").isNotNull())
        .alias("canceled_with_delivery_date"))


def temporal_violations(star: Star) -> DataFrame:
    """A18 on the typed fact table."""
    return temporal_violation_counts(star.fact_orders)


class SharedBase:
    """What several results of one run (A19) are built from, written once to the scratch folder:
    the revenue of each order and the RFM base.  ``star`` is the star with the former bound, and
    with the tables ``derived`` written too (none are if the star was read from files)."""

    def __init__(self, star: Star, derived: tuple[str, ...] = ()):
        spark = star.fact_orders.sparkSession
        self.star = Star({})
        for name, table in star.tables().items():
            self.star.bind(name, self._written(spark, table, name) if name in derived else table)
        self.star.order_revenue = self._written(spark, order_revenue(star), "order-revenue")
        self.rfm = self._written(spark, rfm_base(self.star), "rfm-base")

    @staticmethod
    def _written(spark, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)


# Query name -> builder over the star (A01-A16; A17 and A18 are below), in file-name order.
ANALYSIS_QUERIES = {
    "monthly_revenue_mom": monthly_revenue_mom,
    "aov_trend": aov_trend,
    "category_pareto": category_pareto,
    "revenue_by_state": revenue_by_state,
    "payment_mix": payment_mix,
    "seller_concentration": seller_concentration,
    "order_status_funnel": order_status_funnel,
    "delivery_days_distribution": delivery_days_distribution,
    "late_pct_by_month": late_pct_by_month,
    "late_pct_by_state": late_pct_by_state,
    "late_vs_review": late_vs_review,
    "cohort_retention": cohort_retention,
    "repeat_purchase_rate": repeat_purchase_rate,
    "rfm_scores": rfm_scores,
    "rfm_segment_share": rfm_segment_share,
    "items_vs_payments": items_vs_payments,
}

# Sort order of each result (applied when a result is written or sampled):
# (column, descending) pairs.
RESULT_ORDER = {
    "monthly_revenue_mom": [("month", False)],
    "aov_trend": [("month", False)],
    "category_pareto": [("revenue", True), ("category", False)],
    "revenue_by_state": [("revenue", True), ("state", False)],
    "payment_mix": [("payment_records", True), ("payment_type", False)],
    "seller_concentration": [("revenue_rank", False)],
    "order_status_funnel": [("orders", True), ("order_status", False)],
    "delivery_days_distribution": [("delivery_days", False)],
    "late_pct_by_month": [("month", False)],
    "late_pct_by_state": [("late_pct", True), ("state", False)],
    "late_vs_review": [("is_late", False)],
    "cohort_retention": [("cohort", False), ("month_offset", False)],
    "rfm_scores": [("customer_unique_id", False)],
    "rfm_segment_share": [("r_score", True), ("f_bucket", True)],
    "items_vs_payments": [("abs_diff", True), ("order_id", False)],
}
