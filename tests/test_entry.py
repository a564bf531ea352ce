import importlib

import pytest

entry = importlib.import_module("__spark_entry__")

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "revenue", "mom_growth_pct"]
    assert df.count() > 0


def test_every_oracle_key_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["fact_orders", "category_pareto", "dq_gate", "rfm_segments",
                                  "pivot_category_month", "forecast_seasonal_naive", "stage_all"])
def test_sample_queries_on_smoke_data(spark, name):
    df = entry.queries()[name](spark, SMOKE)
    assert df.count() >= 0
    assert all(t not in ("int", "float") and not t.startswith("decimal") for _, t in df.dtypes)
