"""The operators on the written-out fixture, read through the CSV staging path; expected
values are worked out by hand from its rows."""

import datetime as dt
import functools
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from fixture_data import write_fixture
from mercato.operators import analysis, marts, quality
from mercato.operators.star import Star
from mercato.plans import model as model_mod

JAN, FEB, MAR, APR, MAY = (dt.date(2020, k, 1) for k in range(1, 6))


@pytest.fixture(scope="module")
def m(spark, tmp_path_factory):
    return model_mod.from_csv(spark, str(write_fixture(tmp_path_factory.mktemp("raw"))))


def got(df, key, *cols):
    """{key: the other columns' values}."""
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_staging_keeps_text_and_line_breaks(m):
    rev = m.stg["order_reviews"]
    assert {t for _, t in rev.dtypes} == {"string"}
    assert rev.count() == 7
    assert rev.filter("review_id = 'r2'").first()["review_comment_message"] == "late,\nvery late"
    assert m.stg["customers"].filter("customer_id = 'k1'").first()["customer_zip_code_prefix"] == "01001"


def test_input_checks(m):
    found = {(r["check"], r["detail"]): r["count"] for r in quality.input_checks(m.stg).collect() if r["count"]}
    assert found == {
        ("temporal_sanity", "handed to the carrier before approval"): 1,
        ("temporal_sanity", "with the customer before the carrier"): 1,
        ("temporal_sanity", "canceled, yet handed to the customer"): 1,
        ("null_policy", "order_approved_at: more than 5 in 10000 missing"): 1,
        ("null_policy", "order_delivered_customer_date: more than 100 in 10000 missing"): 1,
        ("null_policy", "review_comment_title: more than 5000 in 10000 missing"): 5,
        ("null_policy", "review_comment_message: more than 5000 in 10000 missing"): 4,
        ("review_duplicates", "review ids used by several rows"): 1,
        ("review_duplicates", "orders reviewed several times"): 1}


def test_gates_pass_with_logged_rows_only(m):
    inp = quality.run_gate(quality.input_checks(m.stg), "input").collect()
    out = quality.run_gate(quality.output_checks(m.star, m.stg), "output").collect()
    assert len(inp) == 9 and all(r["passed"] and r["severity"] == "logged" for r in inp)
    assert [(r["count"], r["passed"]) for r in out] == [(1, True)]


def test_blocking_row_stops_the_gate(m):
    rev = m.stg["order_reviews"]
    for score in ("'9'", "'many'"):  # out of range; not a number
        bad = rev.selectExpr(*(f"{score} AS review_score" if c == "review_score" else c for c in rev.columns))
        with pytest.raises(quality.QualityGateError):
            quality.run_gate(quality.input_checks({**m.stg, "order_reviews": bad}), "input")


def test_lost_fact_row_is_caught(m):
    short = Star({**m.stg, "order_items": m.stg["order_items"].filter("order_id <> 'b'")})
    assert quality.dq_revenue_tieout(short, m.stg).first()["count"] == 1
    assert got(quality.dq_row_reconciliation(short, m.stg), "table", "count")["fact_order_items"] == 1
    with pytest.raises(quality.QualityGateError):
        quality.run_gate(quality.output_checks(short, m.stg), "output")
    assert quality.dq_revenue_tieout(m.star, m.stg).first()["count"] == 0


def test_star_dedup_and_geolocation(m):
    assert got(m.star.order_reviews, "order_id", "review_id") == {
        "a": "r1", "b": "r3", "c": "r4", "d": "r5", "e": "r6", "f": "r6"}
    assert got(m.star.geolocation, "zip_code_prefix", "avg_lat", "avg_lng", "city") == {
        "01001": (-10.25, 20.25, "alpha"), "02002": (-11.0, 21.0, "beta")}


def test_monthly_revenue(m):
    assert got(analysis.monthly_revenue_mom(m.star), "month", "revenue", "mom_growth_pct") == {
        JAN: (Decimal("33.00"), None), FEB: (Decimal("143.00"), 333.3), APR: (Decimal("50.00"), -65.0),
        MAY: (Decimal("77.00"), 54.0)}
    assert got(analysis.aov_trend(m.star), "month", "orders", "aov") == {
        JAN: (1, 33.0), FEB: (2, 71.5), APR: (1, 50.0), MAY: (1, 77.0)}


def test_calendar_growth_shows_months_without_sales(m):
    assert got(marts.kpi_revenue_mom_calendar(marts.vw_sales(m.star)), "month", "revenue", "mom_growth_pct") == {
        JAN: (Decimal("33.00"), None), FEB: (Decimal("143.00"), 333.3), MAR: (Decimal("0.00"), -100.0),
        APR: (Decimal("50.00"), None), MAY: (Decimal("77.00"), 54.0)}


def test_categories_and_sellers(m):
    assert got(analysis.category_pareto(m.star), "category", "revenue", "revenue_share_pct", "cumulative_share_pct") == {
        "tapete": (Decimal("187.00"), 61.72, 61.72), "cups": (Decimal("66.00"), 21.78, 83.5),
        "light": (Decimal("44.00"), 14.52, 98.02), "unknown": (Decimal("6.00"), 1.98, 100.0)}
    assert got(analysis.seller_concentration(m.star), "seller_id", "revenue", "revenue_rank", "cumulative_share_pct") == {
        "south": (Decimal("187.00"), 1, 61.72), "north": (Decimal("116.00"), 2, 100.0)}


def test_payments_and_statuses(m):
    assert got(analysis.payment_mix(m.star), "payment_type", "payment_records", "share_pct", "avg_installments",
               "total_payment_value") == {
        "card": (5, 62.5, 2.2, Decimal("205.00")), "slip": (2, 25.0, 1.0, Decimal("110.01")),
        "voucher": (1, 12.5, 1.0, Decimal("3.00"))}
    assert got(analysis.order_status_funnel(m.star), "order_status", "orders", "share_pct") == {
        "delivered": (5, 71.43), "shipped": (1, 14.29), "canceled": (1, 14.29)}


def test_delivery_and_lateness(m):
    assert got(analysis.delivery_days_distribution(m.star), "delivery_days", "orders") == {3: 2, 5: 1, 10: 2}
    assert got(analysis.late_pct_by_month(m.star), "month", "delivered_orders", "late_orders", "late_pct") == {
        JAN: (1, 0, 0.0), FEB: (2, 1, 50.0), APR: (1, 0, 0.0), MAY: (1, 1, 100.0)}
    assert got(analysis.late_vs_review(m.star), "is_late", "reviewed_orders", "avg_review_score", "median_review_score",
               "pct_1_2_star") == {True: (2, 2.0, 2.0, 100.0), False: (3, 4.0, 4.0, 0.0)}


def test_retention_repeat_rfm(m):
    cohorts = {(r["cohort"], r["month_offset"]): r["active_customers"] for r in analysis.cohort_retention(m.star).collect()}
    assert cohorts == {(JAN, 0): 1, (JAN, 1): 1, (FEB, 0): 1, (FEB, 3): 1, (APR, 0): 1}
    r = analysis.repeat_purchase_rate(m.star).first()
    assert (r["total_customers"], r["repeat_customers"], r["repeat_pct"]) == (3, 2, 66.67)
    assert got(analysis.rfm_scores(m.star), "customer_unique_id", "r_score", "f_bucket", "m_score") == {
        "ana": (1, 2, 3), "cy": (2, 1, 1), "ben": (3, 2, 2)}


def test_reconciliation_and_counts(m):
    assert got(analysis.items_vs_payments(m.star), "order_id", "item_total", "payment_total", "diff") == {
        "d": (Decimal("50.00"), Decimal("45.00"), Decimal("-5.00"))}
    assert analysis.duplicate_review_orders(m.stg["order_reviews"]).first()[0] == 1
    assert tuple(analysis.temporal_violations(m.star).first()) == (1, 1, 1)


def test_a_family_that_fails_leaves_the_others(spark, m):
    """Unreadable staged text: the family that reads it blocks as ``unknown``, the rest report."""
    items = m.stg["order_items"]
    broken = items.withColumn("price", F.when(items.order_item_id == 1, F.raise_error(F.lit("unreadable text"))).otherwise(items.price))
    late = m.stg["order_reviews"].withColumn("review_score", F.lit("9"))
    stg = {**m.stg, "order_items": broken, "order_reviews": late}
    families = {name: functools.partial(fn, stg) for name, fn in quality.INPUT_FAMILIES.items()}
    rows = {(r["check"], r["table"]): r for r in quality.isolated(spark, families).collect()}
    assert "unreadable text" in rows["domain", "unknown"]["detail"] and rows["domain", "unknown"]["severity"] == "blocking"
    assert ("malformed_cast", "unknown") in rows
    assert not any(t == "unknown" for c, t in rows if c not in ("domain", "malformed_cast"))
    assert any(c == "review_duplicates" for c, _ in rows) and any(c == "temporal_sanity" for c, _ in rows)
    with pytest.raises(quality.QualityGateError, match="unknown"):
        quality.gate_input(stg)
    del stg["order_items"]
    with pytest.raises(KeyError):  # a table that is not there at all is a fault of the caller
        quality.gate_input(stg)


def test_one_shuffle_for_each_key(m):
    plan = quality.keyed_input_checks(m.stg)._jdf.queryExecution().executedPlan().toString()
    # orders, items, customers, products, sellers, review ids
    assert plan.count("Exchange hashpartitioning") == 6
