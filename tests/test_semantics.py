"""Semantic corners the documented fixture never reaches: a missing month (A01 vs K9),
tied revenues under the RANGE frame (A03), items x payments fan-out (A16), a repeat
person (A13), the histogram against numpy, and the sinks."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest

from mercato.operators import analysis, eda, marts
from mercato.operators.star import Star
from mercato.sources import sinks


def _stg(spark, orders, items, payments=None, customers=None, products=None):
    oc = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
          "order_approved_at string, order_delivered_carrier_date string, "
          "order_delivered_customer_date string, order_estimated_delivery_date string")
    ic = ("order_id string, order_item_id string, product_id string, seller_id string, "
          "shipping_limit_date string, price string, freight_value string")
    pc = "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string"
    cc = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"
    prc = ("product_id string, product_category_name string, product_name_lenght string, "
           "product_description_lenght string, product_photos_qty string, product_weight_g string, "
           "product_length_cm string, product_height_cm string, product_width_cm string")
    return {
        "orders": spark.createDataFrame(orders, oc),
        "order_items": spark.createDataFrame(items, ic),
        "order_payments": spark.createDataFrame(payments or [], pc),
        "customers": spark.createDataFrame(customers or [], cc),
        "products": spark.createDataFrame(products or [], prc),
        "product_category_translation": spark.createDataFrame(
            [], "product_category_name string, product_category_name_english string"),
    }


def _o(oid, cust, day, status="delivered"):
    return (oid, cust, status, f"{day} 10:00:00", None, None, f"{day} 20:00:00", f"{day} 23:00:00")


def _i(oid, n, pid, price, freight="0.00"):
    return (oid, str(n), pid, "s1", None, price, freight)


def test_missing_month_previous_present_vs_calendar(spark):
    orders = [_o("a", "c1", "2018-01-05"), _o("b", "c1", "2018-03-05")]
    items = [_i("a", 1, "p", "100.00"), _i("b", 1, "p", "150.00")]
    customers = [("c1", "u1", "1", "x", "S")]
    products = [("p", "cat", "1", "1", "1", "1", "1", "1", "1")]
    star = Star(_stg(spark, orders, items, customers=customers, products=products))
    a01 = {r.month: r.mom_growth_pct for r in analysis.monthly_revenue_mom(star).collect()}
    assert a01 == {dt.date(2018, 1, 1): None, dt.date(2018, 3, 1): 50.0}
    k9 = {r.month: r.mom_growth_pct for r in marts.kpi_revenue_mom_calendar(marts.vw_sales(star)).collect()}
    assert k9 == {dt.date(2018, 1, 1): None, dt.date(2018, 2, 1): -100.0, dt.date(2018, 3, 1): None}


def test_pareto_ties_share_one_cumulative_value(spark):
    orders = [_o("a", "c1", "2018-01-05")]
    items = [_i("a", 1, "p1", "50.00"), _i("a", 2, "p2", "50.00"), _i("a", 3, "p3", "100.00")]
    products = [(p, c, "1", "1", "1", "1", "1", "1", "1") for p, c in (("p1", "x"), ("p2", "y"), ("p3", None))]
    star = Star(_stg(spark, orders, items, products=products))
    got = {r.category: (r.revenue, r.revenue_share_pct, r.cumulative_share_pct)
           for r in analysis.category_pareto(star).collect()}
    assert got == {"unknown": (Decimal("100.00"), 50.0, 50.0), "x": (Decimal("50.00"), 25.0, 100.0),
                   "y": (Decimal("50.00"), 25.0, 100.0)}


def test_reconciliation_without_fanout_and_repeat_person(spark):
    orders = [_o("a", "c1", "2018-01-05"), _o("b", "c2", "2018-02-05"), _o("c", "c3", "2018-02-06", "shipped")]
    items = [_i("a", 1, "p", "10.00", "1.00"), _i("a", 2, "p", "10.00", "1.00"), _i("b", 1, "p", "5.00")]
    payments = [("a", "1", "card", "1", "11.00"), ("a", "2", "card", "1", "11.00"), ("b", "1", "card", "1", "5.01")]
    customers = [("c1", "u1", "1", "x", "S"), ("c2", "u1", "1", "x", "S"), ("c3", "u2", "1", "x", "S")]
    star = Star(_stg(spark, orders, items, payments, customers))
    assert analysis.items_vs_payments(star).count() == 0  # 22.00 vs 22.00; 5.00 vs 5.01 within 0.01
    r = analysis.repeat_purchase_rate(star).first()
    assert (r.total_customers, r.repeat_customers, r.repeat_pct) == (1, 1, 100.0)


def test_histogram_matches_numpy(spark):
    days = [0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 40, 40, -3]
    orders = [("o%d" % i, "c", "delivered", "2018-01-01 00:00:00", None, None,
               (dt.datetime(2018, 1, 1) + dt.timedelta(days=d)).strftime("%Y-%m-%d %H:%M:%S"), None)
              for i, d in enumerate(days)]
    star = Star(_stg(spark, orders, []))
    got = {r.bin: r.orders for r in eda.delivery_days_histogram(star, bins=40).collect()}
    counts, _ = np.histogram(np.array(days), bins=40)
    assert {i: int(c) for i, c in enumerate(counts) if c} == got


def test_sinks_write_bounded_samples(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    out = str(tmp_path / "sample")
    sinks.write_result_sample(df, out, n=200, order=[("id", True)])
    back = spark.read.option("header", "true").csv(out)
    assert back.count() == 200 and back.agg({"id": "max"}).first()[0] == "999"
    fc = spark.createDataFrame([(dt.date(2020, 1, 1), 1.5, 0.0, 3.25)], "date date, forecast double, lower double, upper double")
    sinks.publish_forecast(fc, str(tmp_path / "fc"), str(tmp_path / "fc_csv"))
    typed = spark.read.parquet(str(tmp_path / "fc"))
    assert dict(typed.dtypes) == {"date": "date", "forecast": "decimal(18,4)", "lower": "decimal(18,4)",
                                  "upper": "decimal(18,4)"}
    with pytest.raises(ValueError):
        sinks.ctas_overwrite(df)


def test_publish_star_partitions_orders_by_month(spark, tmp_path):
    from fixture_data import write_fixture
    from mercato.operators.star import publish_star
    from mercato.plans import model as model_mod

    m = model_mod.from_csv(spark, str(write_fixture(tmp_path / "raw")))
    out = str(tmp_path / "star")
    publish_star(m.star, out)
    orders = spark.read.parquet(f"{out}/fact_orders")
    assert orders.count() == 7
    february = orders.filter("purchase_month = '2020-02'")
    assert "PartitionFilters: [isnotnull(purchase_month" in february._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(f"{out}/order_reviews").count() == 6


def test_daily_series_per_key_adds_up_to_total(spark):
    from mercato.operators import forecast as fc
    from mercato.plans.model import from_testdata

    m = from_testdata(spark, "/root/testdata/sf0.001")
    total = {r.day: r.orders for r in fc.daily_series(m.star).collect()}
    per_state = fc.daily_series(m.star, by="customer_state")
    sums = {r.day: r.s for r in per_state.groupBy("day").agg({"orders": "sum"})
            .withColumnRenamed("sum(orders)", "s").collect()}
    assert sums == total
    n_states = m.star.dim_customers.select("customer_state").distinct().count()
    assert per_state.select("series_id").distinct().count() <= n_states
