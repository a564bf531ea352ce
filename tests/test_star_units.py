import datetime as dt

from pyspark.sql import functions as F

from mercato.functions.numeric import half_up_div, pct
from mercato.operators import star


def test_review_dedup_rules(spark):
    rows = [("r1", "o1", "4", None, None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
            ("r2", "o1", "2", None, None, "2018-01-01 00:00:00", "2018-01-03 00:00:00"),  # latest wins
            ("r3", "o2", "5", None, None, "2018-01-01 00:00:00", "2018-01-05 00:00:00"),
            ("r0", "o2", "1", None, None, "2018-01-01 00:00:00", None),                   # NULL time sorts first
            ("r9", "o3", "3", None, None, "2018-01-01 00:00:00", "2018-02-01 00:00:00"),
            ("r4", "o3", "4", None, None, "2018-01-01 00:00:00", "2018-02-01 00:00:00")]  # tie -> lowest id
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in star.REVIEW_COLUMNS))
    got = {r.order_id: r.review_id for r in star.order_reviews_latest(df).collect()}
    assert got == {"o1": "r2", "o2": "r0", "o3": "r4"}


def test_geolocation_mode_ties_and_means(spark):
    rows = [("01001", "1.00000001", "2", "b", "X"), ("01001", "2", "4", "a", "X"),
            ("01001", "3", "6", "b", None), ("01001", "4", "8", "a", None),
            ("02002", "5", "5", None, "Y")]
    df = spark.createDataFrame(rows, "geolocation_zip_code_prefix string, geolocation_lat string, "
                                     "geolocation_lng string, geolocation_city string, geolocation_state string")
    got = {r.zip_code_prefix: r for r in star.geolocation_dedup(df).collect()}
    assert got["01001"].city == "a" and got["01001"].state == "X"
    assert got["01001"].avg_lat == 2.5000000025 and got["01001"].avg_lng == 5.0
    assert got["02002"].city is None and got["02002"].state == "Y"
    assert sorted(got) == ["01001", "02002"]  # leading zeros kept


def test_delivery_days_and_lateness(spark):
    rows = [("o1", "c", "delivered", "2018-01-05 00:00:00", None, None, "2018-01-01 12:00:00", "2018-01-10 00:00:00"),
            ("o2", "c", "delivered", "2018-01-01 00:00:00", None, None, "2018-01-04 23:00:00", "2018-01-02 00:00:00"),
            ("o3", "c", "shipped", "2018-01-01 00:00:00", None, None, None, "2018-01-02 00:00:00")]
    cols = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = {r.order_id: (r.delivery_days, r.is_late) for r in star.fact_orders(df).collect()}
    assert got == {"o1": (-3, False), "o2": (3, True), "o3": (None, None)}


def test_products_category_fallback_and_null(spark):
    p = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None)],
                              "product_id string, product_category_name string")
    for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
              "product_length_cm", "product_height_cm", "product_width_cm"):
        p = p.withColumn(c, F.lit("1"))
    t = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    got = {r.product_id: r.product_category_name_english for r in star.dim_products(p, t).collect()}
    assert got == {"p1": "A", "p2": "b", "p3": None}


def test_dim_date(spark):
    d = star.dim_date(spark, "2024-01-05", "2024-01-08").orderBy("date").collect()
    assert [(r.weekday, r.is_weekend) for r in d] == [("Friday", False), ("Saturday", True),
                                                      ("Sunday", True), ("Monday", False)]
    assert d[0].date == dt.date(2024, 1, 5) and d[0].year == 2024 and d[0].month == 1


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (1, 3), (22031, 200), (5, 0)], "n long, d long")
    got = [r.x for r in df.select(half_up_div(F.col("n"), F.col("d"), 2).alias("x")).collect()]
    assert got == [0.13, -0.13, 0.33, 110.16, None]
    assert df.select(pct(F.lit(1), F.lit(3)).alias("p")).first().p == 33.33
