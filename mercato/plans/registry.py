"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the test tables.

Results are normalised for comparison only: DECIMAL and FLOAT become DOUBLE, narrow
integers become BIGINT.  The operators themselves keep exact decimals.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import content
from ..operators import analysis
from ..operators import star as star_ops
from ..session import scratch_path
from ..sources import csv as csv_source
from ..sources import testdata
from . import catalog, snapshots
from . import model as model_mod

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = lambda spark, sf_dir: normalize(fn(spark, sf_dir))
        return fn
    return deco


def _model(spark: SparkSession, sf_dir: str) -> model_mod.Model:
    return model_mod.from_testdata(spark, sf_dir)


def _star_table(name: str) -> QueryFn:
    return lambda spark, sf_dir: getattr(_model(spark, sf_dir).star, name)


def _analysis(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(_model(spark, sf_dir).star)


for _name in star_ops.STAR_TABLES:
    register(_name)(_star_table(_name))


@register("geolocation")
def q_geolocation(spark, sf_dir):
    """T09, means rounded for comparison only (the SQL twin sums in another order)."""
    geo = _model(spark, sf_dir).star.geolocation
    return geo.select("zip_code_prefix", F.round("avg_lat", 6).alias("avg_lat"), F.round("avg_lng", 6).alias("avg_lng"),
                      "city", "state")

for _name, _fn in analysis.ANALYSIS_QUERIES.items():
    register(_name)(_analysis(_fn))


@register("duplicate_review_orders")
def q_duplicate_review_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.duplicate_review_orders(_model(spark, sf_dir).stg["order_reviews"])


@register("temporal_violations")
def q_temporal_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.temporal_violations(_model(spark, sf_dir).star)


# ---------------------------------------------------------------- data quality
from ..operators import quality  # noqa: E402

_INPUT_FAMILIES = {
    "dq_row_counts": quality.dq_row_counts,
    "dq_pk_duplicates": quality.dq_pk_duplicates,
    "dq_orphan_fk": quality.dq_orphan_fk,
    "dq_domain": quality.dq_domain,
    "dq_temporal": quality.dq_temporal,
    "dq_null_policy": quality.dq_null_policy,
    "dq_review_duplicates": quality.dq_review_duplicates,
    "dq_malformed_cast": quality.dq_malformed_cast,
}
for _name, _fn in _INPUT_FAMILIES.items():
    register(_name)((lambda f: lambda spark, sf_dir: f(_model(spark, sf_dir).stg))(_fn))


def _written_star(spark: SparkSession, sf_dir: str) -> tuple[model_mod.Model, star_ops.Star]:
    """The model, and its star as written to a new snapshot and read back."""
    m = _model(spark, sf_dir)
    snapshot = snapshots.new_snapshot(scratch_path(spark, "stars"))
    star_ops.publish_star(m.star, f"{snapshot}/star")
    return m, snapshots.star_at(spark, snapshot)


@register("dq_row_reconciliation")
def q_dq_row_reconciliation(spark, sf_dir):
    """V08 on a star that was written and read back."""
    m, star = _written_star(spark, sf_dir)
    return quality.dq_row_reconciliation(star, m.stg)


@register("dq_output_orphan_fk")
def q_dq_output_orphan_fk(spark, sf_dir):
    return quality.dq_output_orphan_fk(_model(spark, sf_dir).star)


@register("dq_revenue_tieout")
def q_dq_revenue_tieout(spark, sf_dir):
    """V10 on a star that was written and read back."""
    m, star = _written_star(spark, sf_dir)
    return quality.dq_revenue_tieout(star, m.stg)


@register("dq_items_vs_payments")
def q_dq_items_vs_payments(spark, sf_dir):
    return quality.dq_items_vs_payments(_model(spark, sf_dir).star)


def _reports(spark, sf_dir):
    m = _model(spark, sf_dir)
    return (quality.dq_report(quality.input_checks(m.stg), "input"),
            quality.dq_report(quality.output_checks(m.star, m.stg), "output"))


@register("dq_report")
def q_dq_report(spark, sf_dir):
    a, b = _reports(spark, sf_dir)
    return a.unionByName(b)


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    a, b = _reports(spark, sf_dir)
    return quality.dq_summary(a, "input").unionByName(quality.dq_summary(b, "output"))


# ---------------------------------------------------------------- published snapshots
@register("published_star")
def q_published_star(spark, sf_dir):
    """The star built into a snapshot, passed by the output gate as read back,
    published, read through the pointer; (table, rows) of its nine tables.  (The test tables
    repeat item keys, so the input gate, ``dq_gate``, would stop them.)"""
    root = scratch_path(spark, f"published-{uuid.uuid4().hex}")
    snapshots.publish_built(spark, _model(spark, sf_dir).stg, root)
    return csv_source.staged_row_counts(snapshots.read_star(spark, root).tables())


@register("catalog_views")
def q_catalog_views(spark, sf_dir):
    """A day's figures read through the catalog views over a published snapshot."""
    root = scratch_path(spark, f"published-{uuid.uuid4().hex}")
    database = f"mercato_{uuid.uuid4().hex}"
    snapshots.publish_built(spark, _model(spark, sf_dir).stg, root)
    catalog.remake_views(spark, root, database)
    found = catalog.daily_activity(spark, database)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")  # views only; what they read is in the plan
    return found


@register("kpi_revenue_published")
def q_kpi_revenue_published(spark, sf_dir):
    """The revenue measures of a date range, read from the months it touches of a published star."""
    root = scratch_path(spark, f"published-{uuid.uuid4().hex}")
    snapshots.publish_built(spark, _model(spark, sf_dir).stg, root)
    star = marts.slice_star(snapshots.read_star(spark, root), "1994-03-15", "1995-02-10")
    return marts.kpi_revenue(marts.vw_sales(star))


# ---------------------------------------------------------------- views, pivots, KPIs, EDA
from ..operators import eda, marts, slicer_cube  # noqa: E402

for _name, _fn in marts.VIEWS.items():
    register(_name)(_analysis(_fn))


def _sales(spark, sf_dir):
    return marts.vw_sales(_model(spark, sf_dir).star)


register("pivot_category_month")(lambda spark, d: marts.category_month_revenue(_sales(spark, d)))
register("pivot_state")(lambda spark, d: marts.pivot_state(_sales(spark, d)))
register("kpi_revenue")(lambda spark, d: marts.kpi_revenue(_sales(spark, d)))
register("kpi_operations")(
    lambda spark, d: marts.kpi_operations(marts.vw_orders(_model(spark, d).star)))
register("kpi_repeat_pct")(
    lambda spark, d: marts.kpi_repeat_pct(marts.vw_customers(_model(spark, d).star)))
register("kpi_revenue_mom_calendar")(
    lambda spark, d: marts.kpi_revenue_mom_calendar(_sales(spark, d)))
register("kpi_cohort_m1_m3")(
    lambda spark, d: marts.kpi_cohort_m1_m3(analysis.cohort_retention(_model(spark, d).star)))
register("kpi_revenue_sliced")(lambda spark, d: marts.kpi_revenue(marts.apply_slicers(
    _sales(spark, d), start="1995-01-01", end="1996-12-31", categories=["budget", "large_goods"])))
register("kpi_revenue_by_slicer")(lambda spark, d: marts.kpi_revenue_by_slicer(_sales(spark, d)))

@register("kpi_any_slice")
def q_kpi_any_slice(spark, sf_dir):
    """Three different selections, all answered from one written cube of bitmaps."""
    path = scratch_path(spark, f"cube-{uuid.uuid4().hex}")
    slicer_cube.write_cube(_sales(spark, sf_dir), path)
    selections = {"all": {}, "range": {"first": "1993-02", "last": "1994-11", "categories": ["budget", "large_goods", "unknown"]},
                  "states": {"states": ["NATION_1", "NATION_3", "NATION_7"], "first": "1995-01"}}
    found = [slicer_cube.select_kpis(slicer_cube.read_cube(spark, path), **chosen).select(F.lit(name).alias("selection"), "*")
             for name, chosen in selections.items()]
    return functools.reduce(DataFrame.unionByName, found)


for _name in ("daily_order_volume", "daily_order_head_tail", "gap_days", "nulls_by_status",
              "category_item_counts", "state_person_counts", "delivery_days_summary",
              "delivery_days_histogram"):
    register(_name)(_analysis(getattr(eda, _name)))


# ---------------------------------------------------------------- segments and statistics
from ..operators import segments, stats  # noqa: E402

for _name in ("cohort_pct_matrix", "rfm_person_base", "rfm_segments", "segment_summary"):
    register(_name)(_analysis(getattr(segments, _name)))
for _name in ("late_review_describe", "mann_whitney_u", "review_effect_size"):
    register(_name)(_analysis(getattr(stats, _name)))


@register("mann_whitney_pvalue")
def q_mann_whitney_pvalue(spark, sf_dir):
    """N12, the p-value rounded for comparison only."""
    return stats.mann_whitney_pvalue(_model(spark, sf_dir).star).withColumn("p_value", F.round("p_value", 9))


# ---------------------------------------------------------------- forecasting
from ..operators import forecast, packed_series  # noqa: E402


def _series(spark, sf_dir):
    return forecast.daily_series(_model(spark, sf_dir).star)


@register("daily_series")
def q_daily_series(spark, sf_dir):
    return _series(spark, sf_dir)


@register("series_by_state")
def q_series_by_state(spark, sf_dir):
    """N02, N14, N15, N16c for each state, from one packed row a state."""
    return packed_series.series_summary(packed_series.packed_series(_model(spark, sf_dir).star, "customer_state"))


@register("walk_forward_folds")
def q_walk_forward_folds(spark, sf_dir):
    return forecast.walk_forward_folds(_series(spark, sf_dir))


@register("event_lift")
def q_event_lift(spark, sf_dir):
    s = _series(spark, sf_dir)
    return forecast.event_lift(s, folds=forecast.walk_forward_folds(s))


@register("seasonal_naive_backtest")
def q_seasonal_naive_backtest(spark, sf_dir):
    s = _series(spark, sf_dir)
    return forecast.fold_metrics(
        forecast.seasonal_naive_predictions(s, forecast.walk_forward_folds(s)), forecast.SN)


@register("forecast_seasonal_naive")
def q_forecast_seasonal_naive(spark, sf_dir):
    return forecast.seasonal_naive_forecast(_series(spark, sf_dir))


@register("forecast_total_seasonal_naive")
def q_forecast_total_seasonal_naive(spark, sf_dir):
    return forecast.forecast_total(forecast.seasonal_naive_forecast(_series(spark, sf_dir)))


def _backtest(spark, sf_dir):
    return forecast.Backtest(_series(spark, sf_dir))


def _six_places(df: DataFrame) -> DataFrame:
    """Doubles to six places: sums of fitted values differ in the last bits with their order."""
    return df.select(*(F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema))


register("holt_winters_backtest")(
    lambda spark, d: _six_places(forecast.fold_metrics(_backtest(spark, d).hw_preds, forecast.HW)))
register("backtest_table")(lambda spark, d: _six_places(_backtest(spark, d).table()))
register("model_selection")(lambda spark, d: _six_places(_backtest(spark, d).selection()))
register("forecast_28d")(lambda spark, d: _six_places(_backtest(spark, d).forecast()))
register("forecast_total")(lambda spark, d: _six_places(forecast.forecast_total(_backtest(spark, d).forecast())))
register("monitor_thresholds")(lambda spark, d: _six_places(_backtest(spark, d).thresholds()))


@register("model_selection_by_state")
def q_model_selection_by_state(spark, sf_dir):
    """N16g per customer state: each state's own folds, fits and winner, from packed series."""
    days = packed_series.unpacked(packed_series.packed_series(_model(spark, sf_dir).star, "customer_state"))
    return _six_places(forecast.Backtest(days).selection())


@register("recent_actuals_plus_forecast")
def q_recent_actuals_plus_forecast(spark, sf_dir):
    m = _model(spark, sf_dir)
    bt = forecast.Backtest(forecast.daily_series(m.star))
    return _six_places(marts.recent_actuals_plus_forecast(marts.vw_daily_orders(m.star), bt.forecast()))


# ---------------------------------------------------------------- sources and run-all


def _hashed(frames, name: str) -> DataFrame:
    """column_hashes of several frames, with the frame's name as column ``name``."""
    parts = [content.column_hashes(df).select(F.lit(key).alias(name), "*") for key, df in frames.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@register("stage_all")
def q_stage_all(spark, sf_dir):
    """The staging tables written as CSV to the shared scratch folder and staged back
    as text; an order-free hash of every column."""
    raw = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    csv_source.write_staging_csv(testdata.staging_tables(spark, sf_dir), raw)
    frames, _ = csv_source.stage_all(spark, raw)
    return _hashed(frames, "table")


def _results(star: star_ops.Star, stg_reviews: DataFrame) -> dict[str, DataFrame]:
    """The results of all business queries; order revenue and the RFM base are built once."""
    base = analysis.SharedBase(star, derived=("fact_orders", "order_reviews"))
    ranked = ("rfm_scores", "rfm_segment_share")
    results = {name: fn(base.star, base=base.rfm) if name in ranked else fn(base.star) for name, fn in analysis.ANALYSIS_QUERIES.items()}
    results["duplicate_review_orders"] = analysis.duplicate_review_orders(stg_reviews)
    results["temporal_violations"] = analysis.temporal_violations(base.star)
    return results


@register("run_all_queries")
def q_run_all_queries(spark, sf_dir):
    """Every business query evaluated with all its columns; an order-free hash of each."""
    m = _model(spark, sf_dir)
    return _hashed(_results(m.star, m.stg["order_reviews"]), "query")


# ---------------------------------------------------------------- sinks, written and read back
from ..sources import sinks  # noqa: E402


@register("result_samples")
def q_result_samples(spark, sf_dir):
    """Every business query's whole result written as CSV in the result's order, read back
    as text; an order-free hash of every column."""
    m = _model(spark, sf_dir)
    out = scratch_path(spark, f"samples-{uuid.uuid4().hex}")
    results = _results(m.star, m.stg["order_reviews"])
    sinks.run_all_queries(results, out_dir=out, orders=analysis.RESULT_ORDER)
    return _hashed({name: spark.read.schema(", ".join(f"`{c}` string" for c in df.columns)).option("header", "true").csv(f"{out}/{name}")
                    for name, df in results.items()}, "query")


@register("pivot_extract")
def q_pivot_extract(spark, sf_dir):
    """Raw extract and both pivots written and read back; an order-free hash of every column
    of the extract and the state pivot, and of the category pivot as (category, month, revenue)."""
    out = scratch_path(spark, f"pivots-{uuid.uuid4().hex}")
    sinks.pivot_extract_sink(marts.vw_sales(_model(spark, sf_dir).star), out)
    read = {name: spark.read.option("header", "true").csv(f"{out}/{name}") for name in ("raw_extract", "category_month_pivot", "state_pivot")}
    wide = read["category_month_pivot"]
    read["category_month_pivot"] = wide.unpivot("category", [c for c in wide.columns if c != "category"], "month", "revenue")
    return _hashed(read, "output")


@register("published_forecast")
def q_published_forecast(spark, sf_dir):
    """The winning forecast published as a typed table and CSV, read back."""
    out = scratch_path(spark, f"forecast-{uuid.uuid4().hex}")
    bt = forecast.Backtest(forecast.daily_series(_model(spark, sf_dir).star))
    sinks.publish_forecast(bt.forecast(), f"{out}/table", f"{out}/csv")
    return spark.read.parquet(f"{out}/table")
