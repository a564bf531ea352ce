"""Binding of the TPC-H-like test tables to the nine staging tables of the model.

The test tables carry no retail data of their own, so each staging table is a stand-in
derived by Spark from them (README, "Test binding").  Ids keep the source's BIGINT type;
string ids from CSV staging go through the same operators unchanged.  The same binding is
written in SQL in ``mercato.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MONEY

# Fixed values of the binding: order status per TPC-H status letter, and the one category
# that is left without a name (R5) plus the four categories with an English name (the
# remaining one falls back to its native name).
STATUS_BY_LETTER = {"F": "delivered", "O": "shipped", "P": "canceled"}
NULL_CATEGORY_TYPE = "PROMO"
CATEGORY_TRANSLATION = [
    ("economy", "budget"),
    ("large", "large_goods"),
    ("medium", "mid_range"),
    ("small", "small_goods"),
]


# Columns of the test tables.  Naming them saves a job that reads the footers of
# every table of every query.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _zip(col: str):
    return F.lpad(F.col(col).cast("string"), 5, "0")


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    lines = _read(spark, sf_dir, "lineitem")
    ship = (lines.groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    status = F.when(F.col("o_orderstatus") == "F", "delivered")
    for letter, name in list(STATUS_BY_LETTER.items())[1:]:
        status = status.when(F.col("o_orderstatus") == letter, name)
    return (orders.join(ship, orders.o_orderkey == ship.l_orderkey, "left")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                status.alias("order_status"),
                F.col("o_orderdate").alias("order_purchase_timestamp"),
                F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")).alias("order_approved_at"),
                F.col("first_ship").alias("order_delivered_carrier_date"),
                F.col("last_ship").alias("order_delivered_customer_date"),
                F.timestamp_add("DAY", F.substring("o_orderpriority", 1, 1).cast("int") * 30,
                                F.col("o_orderdate")).alias("order_estimated_delivery_date"),
            ))


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    # freight = price x tax rounded half away from zero to the cent, in integer cents
    price_cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    tax_pct = F.round(F.col("l_tax") * 100).cast("long")
    product = price_cents * tax_pct
    freight_cents = F.signum(product).cast("long") * F.floor((F.abs(product) + 50) / 100)
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        (freight_cents / F.lit(100.0)).cast(MONEY).alias("freight_value"),
    )


def stg_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast(MONEY).alias("payment_value"),
    )


def stg_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("review_id"),
        F.when(F.col("event_id") % 5 == 4, F.col("event_id") - 1)
         .otherwise(F.col("event_id")).alias("order_id"),
        (F.floor("value") % 5 + 1).cast("int").alias("review_score"),
        F.when(F.col("event_type") == "view", F.lit(None))
         .otherwise(F.col("event_type")).alias("review_comment_title"),
        F.when(F.col("user_id") % 3 == 0, F.lit(None))
         .otherwise(F.col("props")).alias("review_comment_message"),
        F.to_date("ts").cast("timestamp_ntz").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.floor(F.col("c_custkey") / 2).alias("customer_unique_id"),
                _zip("c_nationkey").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            ))


def stg_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = _read(spark, sf_dir, "supplier")
    nation = _read(spark, sf_dir, "nation")
    return (supp.join(nation, supp.s_nationkey == nation.n_nationkey, "left")
            .select(
                F.col("s_suppkey").alias("seller_id"),
                _zip("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.col("n_name").alias("seller_state"),
            ))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_type") == NULL_CATEGORY_TYPE, F.lit(None))
         .otherwise(F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") * 10 + F.col("p_size")).alias("product_description_lenght"),
        (F.col("p_size") % 5 + 1).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        (F.col("p_size") % 7 + 1).alias("product_height_cm"),
        (F.col("p_size") + 1).alias("product_width_cm"),
    )


def stg_product_category_translation(spark: SparkSession) -> DataFrame:
    """The literal lookup as a local relation (so it carries size statistics)."""
    rows = ", ".join(f"('{a}', '{b}')" for a, b in CATEGORY_TRANSLATION)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)")


def stg_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    return ev.select(
        _zip("user_id").alias("geolocation_zip_code_prefix"),
        F.col("value").alias("geolocation_lat"),
        (-F.col("value")).alias("geolocation_lng"),
        F.col("event_type").alias("geolocation_city"),
        F.col("event_type").alias("geolocation_state"),
    )


class LazyTables(Mapping):
    """Read-only mapping of table name -> DataFrame, each built on first access."""

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def staging_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The nine staging tables, derived from the test tables in ``sf_dir`` when first used."""
    return LazyTables({
        "customers": lambda: stg_customers(spark, sf_dir),
        "geolocation": lambda: stg_geolocation(spark, sf_dir),
        "order_items": lambda: stg_order_items(spark, sf_dir),
        "order_payments": lambda: stg_order_payments(spark, sf_dir),
        "order_reviews": lambda: stg_order_reviews(spark, sf_dir),
        "orders": lambda: stg_orders(spark, sf_dir),
        "products": lambda: stg_products(spark, sf_dir),
        "sellers": lambda: stg_sellers(spark, sf_dir),
        "product_category_translation": lambda: stg_product_category_translation(spark),
    })
