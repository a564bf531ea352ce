"""Star-schema transforms (T01-T10): staging tables -> typed dimensions and facts.

Each transform is a projection with casts, one left join to a small translation table,
or one keyed aggregate; nothing here needs a window or a sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import COORD, MONEY, SIZE, TS

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def dim_date_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per calendar day between the two date columns of a one-row frame."""
    day = F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                               F.expr("INTERVAL 1 DAY"))).alias("date")
    return bounds.select(day).select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "EEEE").alias("weekday"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = "2016-01-01", end: str = "2018-12-31") -> DataFrame:
    """T01 with literal bounds (the model's default calendar)."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                   F.to_date(F.lit(end)).alias("end"))
    return dim_date_between(bounds)


def purchase_span(orders: DataFrame) -> DataFrame:
    """One row: the first and the last purchase date (NULL without orders)."""
    day = F.col("order_purchase_timestamp").try_cast(TS).cast("date")
    return orders.agg(F.min(day).alias("start"), F.max(day).alias("end"))


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    """Order-scoped customer grain; both ids kept."""
    return stg_customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                                "customer_city", "customer_state")


def dim_products(stg_products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category with fallback to the native name; a NULL category stays NULL."""
    t = translation.select("product_category_name", "product_category_name_english")
    p = stg_products.join(t, "product_category_name", "left")  # Spark's size estimates and AQE choose the join
    return p.select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name")
         .alias("product_category_name_english"),
        F.col("product_category_name").alias("product_category_name_pt"),
        F.col("product_name_lenght").cast("int").alias("product_name_length"),
        F.col("product_description_lenght").cast("int").alias("product_description_length"),
        F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
        F.col("product_weight_g").cast(SIZE).alias("product_weight_g"),
        F.col("product_length_cm").cast(SIZE).alias("product_length_cm"),
        F.col("product_height_cm").cast(SIZE).alias("product_height_cm"),
        F.col("product_width_cm").cast(SIZE).alias("product_width_cm"),
    )


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    """T04."""
    return stg_sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def delivery_days(purchase: Column, delivered: Column) -> Column:
    """Whole days from purchase to delivery, truncated toward zero (NULL if undelivered)."""
    return F.timestamp_diff("DAY", purchase, delivered).cast("int")


def fact_orders(stg_orders: DataFrame) -> DataFrame:
    """Typed timestamps, delivery_days and three-valued is_late."""
    o = stg_orders.select(
        "order_id", "customer_id", "order_status",
        *[F.col(c).cast(TS).alias(c) for c in (
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")],
    )
    return o.select(
        "*",
        delivery_days(F.col("order_purchase_timestamp"),
                      F.col("order_delivered_customer_date")).alias("delivery_days"),
        (F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))
        .alias("is_late"),
    )


def fact_order_items(stg_items: DataFrame) -> DataFrame:
    """T06."""
    return stg_items.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id", "seller_id",
        F.col("shipping_limit_date").cast(TS).alias("shipping_limit_date"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
    )


def order_payments(stg_payments: DataFrame) -> DataFrame:
    """Every payment record kept."""
    return stg_payments.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
    )


REVIEW_COLUMNS = ["review_id", "order_id", "review_score", "review_comment_title",
                  "review_comment_message", "review_creation_date", "review_answer_timestamp"]


def order_reviews_latest(stg_reviews: DataFrame) -> DataFrame:
    """One review per order - latest answer time (a NULL time counts as latest, as a
    descending sort with nulls first does), then the lowest review_id.

    Written as a keyed arg-min aggregate rather than a window: the aggregate combines
    map-side, so an order holding a large share of all reviews never lands in one task.
    """
    r = stg_reviews.select(
        "review_id", "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title", "review_comment_message",
        F.col("review_creation_date").cast(TS).alias("review_creation_date"),
        F.col("review_answer_timestamp").cast(TS).alias("review_answer_timestamp"),
    )
    ts = F.col("review_answer_timestamp")
    rank_key = F.struct(
        ts.isNotNull().alias("k0"),
        (-F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts)).alias("k1"),
        F.col("review_id").isNull().alias("k2"),
        F.col("review_id").alias("k3"),
    )
    row = F.struct(*REVIEW_COLUMNS)
    return (r.groupBy("order_id").agg(F.min_by(row, rank_key).alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in REVIEW_COLUMNS]))


def _mean(col: str) -> Column:
    """Exact decimal mean (16 digits in, 20 out; the sum holds 18 digits before the point)."""
    return F.avg(F.col(col).cast(COORD)).cast("double")


def geolocation_dedup(stg_geo: DataFrame) -> DataFrame:
    """Per zip prefix the mean coordinates and the most common city and state
    (ties -> lowest value; NULLs ignored)."""
    return (stg_geo.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"))
            .agg(_mean("geolocation_lat").alias("avg_lat"),
                 _mean("geolocation_lng").alias("avg_lng"),
                 F.mode("geolocation_city", True).alias("city"),
                 F.mode("geolocation_state", True).alias("state")))


class Star:
    """The typed star schema over a mapping of staging frames.

    Tables are built on first access and then reused, so a query that reads two tables
    never plans the other eight.  A star read from a published snapshot also has ``by_month``:
    fact_orders with its partition column.
    """

    by_month: DataFrame | None = None
    order_revenue: DataFrame | None = None  # set by a run that shares it between results

    def __init__(self, stg: Mapping[str, DataFrame]):
        self._stg = stg
        self._built: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self._stg)
        return self._built[name]

    def bind(self, name: str, table: DataFrame) -> None:
        """Use ``table`` (such as a published one) in place of building it."""
        self._built[name] = table

    dim_date = property(lambda self: self._table("dim_date"))
    dim_customers = property(lambda self: self._table("dim_customers"))
    dim_products = property(lambda self: self._table("dim_products"))
    dim_sellers = property(lambda self: self._table("dim_sellers"))
    fact_orders = property(lambda self: self._table("fact_orders"))
    fact_order_items = property(lambda self: self._table("fact_order_items"))
    order_payments = property(lambda self: self._table("order_payments"))
    order_reviews = property(lambda self: self._table("order_reviews"))
    geolocation = property(lambda self: self._table("geolocation"))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._table(name) for name in STAR_TABLES}


_BUILDERS = {
    "dim_date": lambda stg: dim_date_between(purchase_span(stg["orders"])),
    "dim_customers": lambda stg: dim_customers(stg["customers"]),
    "dim_products": lambda stg: dim_products(stg["products"], stg["product_category_translation"]),
    "dim_sellers": lambda stg: dim_sellers(stg["sellers"]),
    "fact_orders": lambda stg: fact_orders(stg["orders"]),
    "fact_order_items": lambda stg: fact_order_items(stg["order_items"]),
    "order_payments": lambda stg: order_payments(stg["order_payments"]),
    "order_reviews": lambda stg: order_reviews_latest(stg["order_reviews"]),
    "geolocation": lambda stg: geolocation_dedup(stg["geolocation"]),
}

# Build order of the transforms (T10), in dependency order.
STAR_TABLES = list(_BUILDERS)


def build_star(stg: Mapping[str, DataFrame]) -> Star:
    """All transforms over a mapping of staging frames (each built when first used)."""
    return Star(stg)


def publish_star(star: Star, out_dir: str, partition_orders_by_month: bool = True) -> None:
    """Overwrite each star table as parquet under ``out_dir`` (S6 per table).

    fact_orders is partitioned by purchase month so date slicers prune files.
    """
    for name, df in star.tables().items():
        writer = df
        if name == "fact_orders" and partition_orders_by_month:
            writer = df.withColumn("purchase_month",
                                   F.date_format("order_purchase_timestamp", "yyyy-MM"))
            # few files a month; adaptive execution splits a month that is large
            writer.hint("rebalance", "purchase_month").write.mode("overwrite").partitionBy("purchase_month").parquet(f"{out_dir}/{name}")
        else:
            writer.write.mode("overwrite").parquet(f"{out_dir}/{name}")
