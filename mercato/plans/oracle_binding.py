"""The test-table binding and the star transforms written once in DuckDB SQL.

Every oracle query is ``WITH <these CTEs>, <its own CTEs> SELECT ...`` over the driver's
fixes for the test tables, so they are the same on both sides; the rounding is written here.
"""

from __future__ import annotations

_TRANSLATION_ROWS = ", ".join(
    f"('{native}', '{english}')" for native, english in [
        ("economy", "budget"), ("large", "large_goods"), ("medium", "mid_range"),
        ("small", "small_goods")])

def hud(num: str, den: str, digits: int = 2) -> str:
    """num / den to ``digits`` places in whole numbers: the quotient goes up by one when twice
    the remainder reaches the divisor (halves away from zero).  NULL for den 0."""
    top, low = f"(CAST({num} AS HUGEINT) * {10 ** digits})", f"CAST({den} AS HUGEINT)"
    up = f"CAST(2 * (abs({top}) % abs({low})) >= abs({low}) AS INTEGER)"
    whole = f"(abs({top}) // abs({low}) + {up}) * sign({top}) * sign({low})"
    return f"(CASE WHEN {low} <> 0 THEN CAST({whole} AS DOUBLE) / {float(10 ** digits)} END)"


def _mean_degrees(column: str) -> str:
    """Mean to six digits of values read to eight (at 16 a mean can lie just below a tie that
    its nearest double lies on)."""
    value = f"CAST(CAST(CAST({column} AS DECIMAL(18,8)) AS DECIMAL(38,8)) * 100000000 AS HUGEINT)"
    return hud(f"sum({value})", f"(count({column}) * 100000000)", 6)


_GEO_MEAN_LAT = _mean_degrees("geolocation_lat")
_GEO_MEAN_LNG = _mean_degrees("geolocation_lng")

BINDING_CTES = f"""
stg_orders AS (
    SELECT o.o_orderkey AS order_id,
           o.o_custkey AS customer_id,
           CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                WHEN 'P' THEN 'canceled' END AS order_status,
           o.o_orderdate AS order_purchase_timestamp,
           o.o_orderdate + INTERVAL 1 DAY AS order_approved_at,
           s.first_ship AS order_delivered_carrier_date,
           s.last_ship AS order_delivered_customer_date,
           o.o_orderdate + to_days(30 * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER))
               AS order_estimated_delivery_date
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
               FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey
),
stg_order_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2)
                AS DECIMAL(18,2)) AS freight_value
    FROM lineitem
),
stg_order_payments AS (
    SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
           CAST(o_orderkey % 4 + 1 AS INTEGER) AS payment_installments,
           CAST(o_totalprice AS DECIMAL(18,2)) AS payment_value
    FROM orders
),
stg_order_reviews AS (
    SELECT event_id AS review_id,
           CASE WHEN event_id % 5 = 4 THEN event_id - 1 ELSE event_id END AS order_id,
           CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS review_score,
           CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS review_comment_title,
           CASE WHEN user_id % 3 = 0 THEN NULL ELSE props END AS review_comment_message,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date,
           ts AS review_answer_timestamp
    FROM events
),
stg_customers AS (
    SELECT c_custkey AS customer_id, CAST(floor(c_custkey / 2) AS BIGINT) AS customer_unique_id,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           c_mktsegment AS customer_city, n_name AS customer_state
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
stg_sellers AS (
    SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           s_name AS seller_city, n_name AS seller_state
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
stg_products AS (
    SELECT p_partkey AS product_id,
           CASE WHEN p_type = 'PROMO' THEN NULL ELSE lower(p_type) END AS product_category_name,
           length(p_name) AS product_name_lenght,
           length(p_name) * 10 + p_size AS product_description_lenght,
           p_size % 5 + 1 AS product_photos_qty,
           p_retailprice AS product_weight_g,
           p_size AS product_length_cm,
           p_size % 7 + 1 AS product_height_cm,
           p_size + 1 AS product_width_cm
    FROM part
),
stg_product_category_translation AS (
    SELECT * FROM (VALUES {_TRANSLATION_ROWS}) t(product_category_name, product_category_name_english)
),
stg_geolocation AS (
    SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
           value AS geolocation_lat, -value AS geolocation_lng,
           event_type AS geolocation_city, event_type AS geolocation_state
    FROM events
),
dim_customers AS (
    SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
    FROM stg_customers
),
dim_products AS (
    SELECT p.product_id,
           COALESCE(t.product_category_name_english, p.product_category_name) AS product_category_name_english,
           p.product_category_name AS product_category_name_pt,
           CAST(p.product_name_lenght AS INTEGER) AS product_name_length,
           CAST(p.product_description_lenght AS INTEGER) AS product_description_length,
           CAST(p.product_photos_qty AS INTEGER) AS product_photos_qty,
           CAST(p.product_weight_g AS DECIMAL(18,4)) AS product_weight_g,
           CAST(p.product_length_cm AS DECIMAL(18,4)) AS product_length_cm,
           CAST(p.product_height_cm AS DECIMAL(18,4)) AS product_height_cm,
           CAST(p.product_width_cm AS DECIMAL(18,4)) AS product_width_cm
    FROM stg_products p
    LEFT JOIN stg_product_category_translation t ON p.product_category_name = t.product_category_name
),
dim_sellers AS (
    SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM stg_sellers
),
fact_orders AS (
    SELECT *,
           CAST(date_sub('day', order_purchase_timestamp, order_delivered_customer_date) AS INTEGER)
               AS delivery_days,
           order_delivered_customer_date > order_estimated_delivery_date AS is_late
    FROM stg_orders
),
fact_order_items AS (
    SELECT order_id, CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id,
           shipping_limit_date, price, freight_value
    FROM stg_order_items
),
order_payments AS (
    SELECT order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
           payment_installments, payment_value
    FROM stg_order_payments
),
order_reviews AS (
    SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
           review_creation_date, review_answer_timestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                       ORDER BY review_answer_timestamp DESC NULLS FIRST,
                                                review_id ASC NULLS LAST) AS rn_
          FROM stg_order_reviews)
    WHERE rn_ = 1
),
geo_city_ AS (
    SELECT z, city FROM (
        SELECT geolocation_zip_code_prefix AS z, geolocation_city AS city,
               row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                                  ORDER BY count(*) DESC, geolocation_city ASC) AS rn_
        FROM stg_geolocation WHERE geolocation_city IS NOT NULL GROUP BY 1, 2)
    WHERE rn_ = 1
),
geo_state_ AS (
    SELECT z, state FROM (
        SELECT geolocation_zip_code_prefix AS z, geolocation_state AS state,
               row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                                  ORDER BY count(*) DESC, geolocation_state ASC) AS rn_
        FROM stg_geolocation WHERE geolocation_state IS NOT NULL GROUP BY 1, 2)
    WHERE rn_ = 1
),
geolocation AS (
    SELECT g.zip_code_prefix, g.avg_lat, g.avg_lng, c.city, s.state
    FROM (SELECT geolocation_zip_code_prefix AS zip_code_prefix,
                 {_GEO_MEAN_LAT} AS avg_lat, {_GEO_MEAN_LNG} AS avg_lng
          FROM stg_geolocation GROUP BY 1) g
    LEFT JOIN geo_city_ c ON g.zip_code_prefix = c.z
    LEFT JOIN geo_state_ s ON g.zip_code_prefix = s.z
)"""


def with_binding(ctes: str, select: str) -> str:
    """Full oracle statement: binding CTEs, the query's own CTEs, then its SELECT."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {BINDING_CTES}{extra}\n{select.strip()}"
