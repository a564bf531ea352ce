"""BI feeding views (W1-W5), pivots (P1-P2) and KPI measures.

Views are lazy DataFrames (Catalyst inlines them into whatever reads them); pivots
aggregate before they pivot, so only one row per (category, month) is ever reshaped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import (cents, from_cents, is_delivered, line_revenue,
                                 line_revenue_cents, month_label, month_start)
from ..functions.numeric import half_up_div, pct
from .star import Star


def vw_sales(star: Star) -> DataFrame:
    """Delivered item lines with category, state, person, order date and revenue."""
    # customers join the orders, not their lines, of which there are several an order
    o = (star.fact_orders.filter(is_delivered()).select("order_id", "customer_id", "order_purchase_timestamp")
         .join(star.dim_customers.select("customer_id", "customer_state", "customer_unique_id"), "customer_id"))
    return (star.fact_order_items
            .join(o, "order_id")
            .join(star.dim_products.select("product_id", "product_category_name_english"), "product_id")
            .select("order_id", "order_item_id", "product_id", "seller_id",
                    "product_category_name_english", "customer_state", "customer_unique_id",
                    "order_purchase_timestamp",
                    F.to_date("order_purchase_timestamp").alias("order_date"),
                    line_revenue().alias("line_revenue")))


def vw_orders(star: Star) -> DataFrame:
    """Delivered orders with state, lateness and (if any) the kept review score."""
    o = star.fact_orders.filter(is_delivered())
    return (o.join(star.dim_customers.select("customer_id", "customer_state"), "customer_id")
            .join(star.order_reviews.select("order_id", "review_score"), "order_id", "left")
            .select("order_id", "customer_id", "customer_state", "order_purchase_timestamp",
                    F.to_date("order_purchase_timestamp").alias("order_date"),
                    "delivery_days", "is_late", "order_estimated_delivery_date",
                    "order_delivered_customer_date", "review_score"))


def vw_customers(star: Star) -> DataFrame:
    """Person grain - delivered orders, lifetime revenue, first/last order, repeat
    flag.  Orders without items drop out (inner join to items)."""
    per_order = (star.fact_order_items.groupBy("order_id")
                 .agg(F.sum(line_revenue_cents()).alias("order_revenue")))
    o = star.fact_orders.filter(is_delivered()).select("order_id", "customer_id",
                                                       "order_purchase_timestamp")
    j = (o.join(per_order, "order_id")
         .join(star.dim_customers.select("customer_id", "customer_unique_id"), "customer_id"))
    agg = j.groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("delivered_orders"),
        from_cents(F.sum("order_revenue")).alias("lifetime_revenue"),
        F.min("order_purchase_timestamp").alias("first_order"),
        F.max("order_purchase_timestamp").alias("last_order"))
    return agg.withColumn("is_repeat", F.col("delivered_orders") >= 2)


def vw_daily_orders(star: Star) -> DataFrame:
    """Every placed order counted per purchase day."""
    return (star.fact_orders.groupBy(F.to_date("order_purchase_timestamp").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("orders")))


VIEWS = {"vw_sales": vw_sales, "vw_orders": vw_orders, "vw_customers": vw_customers,
         "vw_daily_orders": vw_daily_orders}


def build_views(star: Star) -> dict[str, DataFrame]:
    """Register the four views as temporary views; returns them by name."""
    out = {}
    for name, fn in VIEWS.items():
        df = fn(star)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


# ---------------------------------------------------------------- pivots


def sales_extract(sales: DataFrame) -> DataFrame:
    """The pivot source: order, category ('unknown' when missing), state, date, month."""
    return sales.select(
        "order_id",
        F.coalesce("product_category_name_english", F.lit("unknown")).alias("category"),
        F.col("customer_state").alias("state"), "order_date",
        month_label("order_date").alias("month"), "line_revenue",
        cents("line_revenue").alias("line_cents"))


def pivot_category_month(sales: DataFrame, months: list[str] | None = None,
                         total_label: str = "Total") -> DataFrame:
    """Category x month revenue with zero fill and grand totals on both axes, as a wide
    table.  The total row is told apart by its grouping flag, so a category that is called
    like the label keeps its own row.
    """
    cells = (category_month_revenue(sales)
             .withColumn("month", F.when(F.col("month_total"), F.lit(total_label)).otherwise(F.col("month"))))
    values = None if months is None else [*months, total_label]
    wide = cells.groupBy("category_total", "category").pivot("month", values).agg(F.first("revenue"))
    value_cols = [c for c in wide.columns if c not in ("category_total", "category")]
    return wide.na.fill(0, subset=value_cols).select(
        F.when(F.col("category_total"), F.lit(total_label)).otherwise(F.col("category")).alias("category"),
        *[F.round(F.col(f"`{c}`"), 2).alias(c) for c in value_cols])


def category_month_revenue(sales: DataFrame) -> DataFrame:
    """P1 in long form: revenue of every category in every month (0 where there is none), of
    each category, of each month and in all; flags mark the totals, whose labels are NULL.

    Item lines are summed to one row per category and month before the cube, which then
    expands only those.
    """
    cell = sales_extract(sales).groupBy("category", "month").agg(F.sum("line_cents").alias("line_cents"))
    cube = (cell.cube("category", "month")
            .agg(F.sum("line_cents").alias("c"), (F.grouping("category") == 1).alias("category_total"),
                 (F.grouping("month") == 1).alias("month_total")))
    rows = cube.where("category_total OR month_total")
    # categories x months cells: labels only, never item lines
    grid = (cell.select("category").distinct().crossJoin(cell.select("month").distinct())
            .join(cell, ["category", "month"], "left")
            .select("category", "month", F.coalesce("line_cents", F.lit(0)).alias("c"),
                    F.lit(False).alias("category_total"), F.lit(False).alias("month_total")))
    return rows.where("c IS NOT NULL").unionByName(grid).select(
        "category", "month", "category_total", "month_total", from_cents("c").alias("revenue"))


def pivot_state(sales: DataFrame) -> DataFrame:
    """Revenue and distinct orders per state."""
    ext = sales_extract(sales)
    return ext.groupBy("state").agg(F.count_distinct("order_id").alias("orders"),
                                    from_cents(F.sum("line_cents")).alias("revenue"))


# ---------------------------------------------------------------- KPI measures


def kpi_revenue(sales: DataFrame) -> DataFrame:
    """K1-K3: total revenue, distinct orders, average order value (NULL if no orders)."""
    agg = sales.agg(F.sum(cents("line_revenue")).alias("_cents"),
                    F.count_distinct("order_id").alias("total_orders"))
    return agg.select(from_cents("_cents").alias("total_revenue"), "total_orders",
                      half_up_div(F.col("_cents"), F.col("total_orders") * F.lit(100), 2).alias("aov"))


def kpi_operations(orders_view: DataFrame) -> DataFrame:
    """K4-K7: late %, median delivery days, mean review score, % of 1-2 star scores.

    Late % counts every delivered order in the denominator (unknown lateness included);
    the 1-2 star share is over orders that have a score.
    """
    return orders_view.agg(
        pct(F.count_if(F.col("is_late")), F.count(F.lit(1))).alias("late_pct"),
        F.median("delivery_days").alias("median_delivery_days"),
        half_up_div(F.sum("review_score"), F.count("review_score"), 2).alias("avg_review_score"),
        pct(F.count_if(F.col("review_score") <= 2), F.count("review_score")).alias("pct_1_2_star"))


def kpi_repeat_pct(customers_view: DataFrame) -> DataFrame:
    """K8: distinct repeat persons over distinct persons."""
    # the view has one row per person, so distinct persons are non-null person rows (no
    # distinct-aggregate expansion needed)
    person = F.col("customer_unique_id")
    agg = customers_view.agg(
        F.count_if(F.col("is_repeat") & person.isNotNull()).alias("repeat_customers"),
        F.count(person).alias("customers"))
    return agg.select("repeat_customers", "customers",
                      pct(F.col("repeat_customers"), F.col("customers")).alias("repeat_pct"))


def kpi_revenue_mom_calendar(sales: DataFrame) -> DataFrame:
    """K9: revenue growth against the calendar-previous month, for every month from the first
    to the last one with sales.  A month without sales has revenue 0 (growth -100 %); growth
    is NULL for the first month and after a month of revenue 0."""
    sold = sales.groupBy(month_start("order_date").alias("month")).agg(F.sum(cents("line_revenue")).alias("_c"))
    span = sold.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).where("lo IS NOT NULL")
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    m = spine.join(sold, "month", "left").select("month", F.coalesce("_c", F.lit(0)).alias("revenue"))
    before = F.lag("revenue").over(Window.orderBy("month"))  # one row per calendar month
    return m.withColumn("_prev", before).select(
        "month", from_cents("revenue").alias("revenue"),
        half_up_div((F.col("revenue") - F.col("_prev")) * F.lit(100), F.col("_prev"), 1).alias("mom_growth_pct"))


def kpi_cohort_m1_m3(cohorts: DataFrame, offsets: tuple[int, ...] = (1, 3)) -> DataFrame:
    """Per cohort the size and the % active at the given month offsets."""
    size = F.sum(F.when(F.col("month_offset") == 0, F.col("active_customers")))
    aggs = [size.alias("cohort_size")]
    for k in offsets:
        active = F.sum(F.when(F.col("month_offset") == k, F.col("active_customers")))
        aggs.append(pct(F.coalesce(active, F.lit(0)), size).alias(f"m{k}_retention_pct"))
    return cohorts.groupBy("cohort").agg(*aggs)


def apply_slicers(df: DataFrame, date_col: str = "order_date", start: str | None = None,
                  end: str | None = None, states: list[str] | None = None,
                  categories: list[str] | None = None, state_col: str = "customer_state",
                  category_col: str = "product_category_name_english") -> DataFrame:
    """Optional date-range, state and category filters on a view, applied before any
    measure.  ``slice_star`` is the way to a date range that reads only its months."""
    if start:
        df = df.filter(F.col(date_col) >= F.to_date(F.lit(start)))
    if end:
        df = df.filter(F.col(date_col) <= F.to_date(F.lit(end)))
    if states:
        df = df.filter(F.col(state_col).isin(states))
    if categories:
        df = df.filter(F.coalesce(F.col(category_col), F.lit("unknown")).isin(categories))
    return df


def slice_star(star: Star, start: str, end: str) -> Star:
    """The star with the orders bought from ``start`` to ``end`` (dates, both included).

    The range is turned into one of months, the partition column of a published star, so only
    those months' files are listed and read; the timestamps then decide.  Orders without a
    purchase time are in no range.  A star that was not published has no months and is filtered.
    """
    first, after = F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1)
    orders = star.fact_orders if star.by_month is None else star.by_month.filter(
        (F.col("purchase_month") >= start[:7]) & (F.col("purchase_month") <= end[:7]))
    bought = F.col("order_purchase_timestamp")
    sliced = Star({})
    for name, table in star.tables().items():
        sliced.bind(name, table)
    sliced.bind("fact_orders", orders.filter((bought >= first) & (bought < after)).drop("purchase_month"))
    return sliced


def kpi_revenue_by_slicer(sales: DataFrame) -> DataFrame:
    """K11 at slicer grain: the revenue measures for every (state, category) pair, i.e.
    what each single-value slicer selection shows."""
    ext = sales_extract(sales)
    agg = ext.groupBy("state", "category").agg(
        F.sum("line_cents").alias("_cents"),
        F.count_distinct("order_id").alias("total_orders"))
    return agg.select("state", "category", from_cents("_cents").alias("total_revenue"), "total_orders",
                      half_up_div(F.col("_cents"), F.col("total_orders") * F.lit(100), 2).alias("aov"))


def recent_actuals_plus_forecast(daily: DataFrame, forecast: DataFrame, days: int = 90) -> DataFrame:
    """The last ``days`` days of actual daily orders stacked with the forecast band
    (a one-row max-date aggregate bounds the actuals); series_id stays where the forecast has it."""
    last = daily.agg(F.max("order_date").alias("_last"))
    recent = (daily.crossJoin(last)
              .filter(F.col("order_date") > F.date_sub("_last", days))
              .select(F.col("order_date").alias("date"), F.col("orders").cast("double").alias("actual")))
    fc = forecast.select(*(c for c in ("series_id", "date", "forecast", "lower", "upper") if c in forecast.columns))
    return recent.unionByName(fc, allowMissingColumns=True)
