"""Exact cents, a category named like the total, and a star row that goes missing."""

from decimal import Decimal

from pyspark.sql import functions as F

from mercato.functions.columns import cents, from_cents
from mercato.operators import marts


def test_cents_are_exact(spark):
    values = ["90071992547409.93", "9999999999999999.99", "-0.01", "0.10"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "m decimal(18,2)")
    got = [str(r["m"]) for r in df.select(from_cents(cents("m")).alias("m")).collect()]
    assert got == values


def test_category_called_total(spark):
    rows = [(1, "Total", "A", "2020-01-05", "10.00"), (2, "toys", "A", "2020-02-05", "5.00")]
    sales = (spark.createDataFrame(rows, "order_id long, product_category_name_english string, customer_state string, d string, r string")
             .select("order_id", "product_category_name_english", "customer_state", F.to_date("d").alias("order_date"),
                     F.col("r").cast("decimal(18,2)").alias("line_revenue")))
    wide = marts.pivot_category_month(sales)
    got = sorted((r["category"], float(r["2020-01"]), float(r["2020-02"]), float(r["Total"])) for r in wide.collect())
    assert got == [("Total", 10.0, 0.0, 10.0), ("Total", 10.0, 5.0, 15.0), ("toys", 0.0, 5.0, 5.0)]
    assert marts.category_month_revenue(sales).count() == 9
    assert marts.category_month_revenue(sales.limit(0)).count() == 0
