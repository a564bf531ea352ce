"""Daily series of many keys, one row a key (N02, N14, N15, N16c per key).

A series is an array of daily counts over the calendar span, so gaps, trailing means, lift and
the seasonal-naive forecast are array expressions: no join of days with keys, one shuffle by key
whose rows are at most a key's days with orders, and one-row bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .forecast import HORIZON, SEASON
from .star import Star, purchase_span

#: Days before a day that its lift is measured against.
BASELINE_DAYS = 14


def packed_series(star: Star, by: str) -> DataFrame:
    """(series_id, first_day, orders): per value of the customers' column ``by`` the placed
    orders of each day from the first to the last purchase day of all; 0 on days without."""
    placed = (star.fact_orders.select("customer_id", F.to_date("order_purchase_timestamp").alias("day"))
              .join(star.dim_customers.select("customer_id", F.col(by).cast("string").alias("series_id")), "customer_id")
              .where("day IS NOT NULL").groupBy("series_id", "day").agg(F.count(F.lit(1)).alias("n")))
    counted = placed.groupBy("series_id").agg(F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("counts"))
    days = F.sequence(F.col("start"), F.col("end"), F.expr("INTERVAL 1 DAY"))
    return (counted.crossJoin(F.broadcast(purchase_span(star.fact_orders)))  # one row
            .select("series_id", F.col("start").alias("first_day"),
                    F.transform(days, lambda d: F.coalesce(F.try_element_at(F.col("counts"), d), F.lit(0).cast("long"))).alias("orders")))


def unpacked(packed: DataFrame) -> DataFrame:
    """One row a day, as ``forecast.daily_series`` has them: no join of days with keys."""
    return packed.select("series_id", "first_day", F.posexplode("orders").alias("day_index", "orders")).select(
        "series_id", F.date_add("first_day", F.col("day_index")).alias("day"), "day_index", "orders")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def lifts(orders: str = "orders", days: int = BASELINE_DAYS) -> Column:
    """Per day the orders over the mean of up to ``days`` days before; NULL on the first day and
    after days without orders."""
    def lift(x: Column, i: Column) -> Column:
        n = F.least(i, F.lit(days))
        before = _sum(F.slice(orders, F.greatest(i - days + 1, F.lit(1)), n))
        return F.when(before > 0, x * n / before)
    return F.transform(orders, lift)


def naive_forecast(orders: str = "orders", horizon: int = HORIZON, season: int = SEASON) -> Column:
    """The last season again and again, for ``horizon`` days; NULL for shorter series."""
    at = lambda s: F.size(orders) - season + (s % season)
    return F.when(F.size(orders) >= season, F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda s: F.get(F.col(orders), at(s))))


def series_summary(packed: DataFrame) -> DataFrame:
    """Per series: days, orders, days without orders, greatest lift and its first day, forecast total."""
    lifted = packed.withColumn("lift", lifts())
    top = F.array_max("lift")
    return lifted.select(
        "series_id", F.size("orders").cast("long").alias("days"), _sum(F.col("orders")).alias("total"),
        F.size(F.filter("orders", lambda x: x == 0)).cast("long").alias("gap_days"), F.round(top, 9).alias("max_lift"),
        F.when(top.isNotNull(), F.date_add("first_day", (F.array_position("lift", top) - 1).cast("int"))).alias("max_lift_day"),
        _sum(naive_forecast()).alias("forecast_total")).withColumnRenamed("total", "orders")
