"""Catalog views over the published star (S7, W5): they are SQL texts kept in the catalog, so
they serve other sessions of a persistent catalog and any SQL client, and are remade after each
publish so that they read the new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import STAR_TABLES
from ..sources.csv import staged_row_counts
from . import snapshots

#: Tables in which others look up rows by key.  With more rows than this their views ask for a
#: merge join: Spark judges a broadcast by the bytes of the file, where a sorted key takes one or
#: two a row, and the driver holds 33 to 66 a row of what is broadcast.
LOOKED_UP = ("dim_customers", "dim_products", "dim_sellers", "order_reviews")
BROADCAST_ROWS = 1 << 18

#: The view columns are fixed output names; {db} is the database that holds the star's views.
VIEW_SQL = {
    "vw_sales": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, p.product_category_name_english, c.customer_state,
               c.customer_unique_id, o.order_purchase_timestamp, to_date(o.order_purchase_timestamp) AS order_date,
               i.price + i.freight_value AS line_revenue
        FROM {db}.fact_order_items i
        JOIN {db}.fact_orders o ON o.order_id = i.order_id AND o.order_status = 'delivered'
        JOIN {db}.dim_products p ON p.product_id = i.product_id
        JOIN {db}.dim_customers c ON c.customer_id = o.customer_id""",
    "vw_orders": """
        SELECT o.order_id, o.customer_id, c.customer_state, o.order_purchase_timestamp,
               to_date(o.order_purchase_timestamp) AS order_date, o.delivery_days, o.is_late, o.order_estimated_delivery_date,
               o.order_delivered_customer_date, r.review_score
        FROM {db}.fact_orders o
        JOIN {db}.dim_customers c ON c.customer_id = o.customer_id
        LEFT JOIN {db}.order_reviews r ON r.order_id = o.order_id
        WHERE o.order_status = 'delivered'""",
    "vw_customers": """
        SELECT customer_unique_id, count(*) AS delivered_orders, CAST(sum(order_revenue) AS DECIMAL(38,2)) AS lifetime_revenue,
               min(order_purchase_timestamp) AS first_order, max(order_purchase_timestamp) AS last_order, count(*) >= 2 AS is_repeat
        FROM (SELECT order_id, sum(price + freight_value) AS order_revenue FROM {db}.fact_order_items GROUP BY order_id) i
        JOIN {db}.fact_orders o ON o.order_id = i.order_id AND o.order_status = 'delivered'
        JOIN {db}.dim_customers c ON c.customer_id = o.customer_id
        GROUP BY customer_unique_id""",
    "vw_daily_orders": """
        SELECT to_date(order_purchase_timestamp) AS order_date, count(*) AS orders
        FROM {db}.fact_orders GROUP BY to_date(order_purchase_timestamp)""",
}


def _too_many_to_broadcast(spark: SparkSession, snapshot: str) -> set[str]:
    """Names of the looked-up tables of a snapshot with more than BROADCAST_ROWS rows (counted from
    the files' footers; a snapshot does not change)."""
    counts = staged_row_counts({name: spark.read.parquet(f"{snapshot}/star/{name}") for name in LOOKED_UP})
    return {r["table"] for r in counts.where(counts["rows"] > BROADCAST_ROWS).collect()}


def remake_views(spark: SparkSession, root: str, database: str) -> dict[str, DataFrame]:
    """Define the star's tables and the four BI views over the snapshot that ``root`` points to,
    replacing those over an earlier one; returns the BI views by name."""
    snapshot = snapshots.current(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root.rstrip('/')}/catalog'")
    large = _too_many_to_broadcast(spark, snapshot)
    for name in STAR_TABLES:
        hint = f"/*+ MERGE({name}) */ " if name in large else ""
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} AS SELECT {hint}* FROM parquet.`{snapshot}/star/{name}` AS {name}")
    for name, sql in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} AS {sql.format(db=f'`{database}`')}")
    return {name: spark.table(f"`{database}`.{name}") for name in VIEW_SQL}


def daily_activity(spark: SparkSession, database: str) -> DataFrame:
    """A day's figures through the four views: placed, delivered and late orders, scores,
    revenue in cents, persons with their first delivered order that day."""
    db = f"`{database}`"
    return spark.sql(f"""
        WITH sold AS (SELECT order_date, CAST(sum(line_revenue) * 100 AS BIGINT) AS revenue_cents, count(*) AS items
                      FROM {db}.vw_sales GROUP BY order_date),
             sent AS (SELECT order_date, count(*) AS delivered_orders, count_if(is_late) AS late_orders,
                             sum(review_score) AS score_sum, count(review_score) AS scores FROM {db}.vw_orders GROUP BY order_date),
             new AS (SELECT to_date(first_order) AS order_date, count(*) AS new_customers, count_if(is_repeat) AS to_return,
                            CAST(sum(lifetime_revenue) * 100 AS BIGINT) AS lifetime_cents
                     FROM {db}.vw_customers GROUP BY to_date(first_order))
        SELECT order_date, orders, delivered_orders, late_orders, score_sum, scores, revenue_cents, items, new_customers, to_return, lifetime_cents
        FROM {db}.vw_daily_orders LEFT JOIN sold USING (order_date) LEFT JOIN sent USING (order_date) LEFT JOIN new USING (order_date)""")
