"""Column lists of the nine source files and the typed star tables.

Staging is a verbatim text mirror: every source column is read as STRING with an explicit
schema (no inference), and typing happens in the star transforms.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Source column names, spelled as in the source files (including the
# source's own spelling "lenght").
STAGING_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        "price", "freight_value",
    ],
    "order_payments": [
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date", "review_answer_timestamp",
    ],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "product_category_translation": [
        "product_category_name", "product_category_name_english",
    ],
}

STAGING_TABLES = list(STAGING_COLUMNS)

# Target types of the star schema.  Money is DECIMAL(18,2); sizes DECIMAL(18,4);
# coordinates DECIMAL(18,8); timestamps carry no zone.
MONEY = "decimal(18,2)"
SIZE = "decimal(18,4)"
COORD = "decimal(24,16)"
TS = "timestamp_ntz"

# Every cast the star transforms apply to staging text: (table, column, type).
# V12 counts values that fail exactly these casts.
CAST_PLAN: list[tuple[str, str, str]] = [
    ("products", "product_name_lenght", "int"),
    ("products", "product_description_lenght", "int"),
    ("products", "product_photos_qty", "int"),
    ("products", "product_weight_g", SIZE),
    ("products", "product_length_cm", SIZE),
    ("products", "product_height_cm", SIZE),
    ("products", "product_width_cm", SIZE),
    ("orders", "order_purchase_timestamp", TS),
    ("orders", "order_approved_at", TS),
    ("orders", "order_delivered_carrier_date", TS),
    ("orders", "order_delivered_customer_date", TS),
    ("orders", "order_estimated_delivery_date", TS),
    ("order_items", "order_item_id", "int"),
    ("order_items", "shipping_limit_date", TS),
    ("order_items", "price", MONEY),
    ("order_items", "freight_value", MONEY),
    ("order_payments", "payment_sequential", "int"),
    ("order_payments", "payment_installments", "int"),
    ("order_payments", "payment_value", MONEY),
    ("order_reviews", "review_score", "int"),
    ("order_reviews", "review_creation_date", TS),
    ("order_reviews", "review_answer_timestamp", TS),
    ("geolocation", "geolocation_lat", COORD),
    ("geolocation", "geolocation_lng", COORD),
]


def staging_schema(table: str) -> StructType:
    """All-text schema of one source file."""
    return StructType([StructField(c, StringType(), True) for c in STAGING_COLUMNS[table]])
