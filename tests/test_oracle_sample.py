"""A sample of registered queries against their DuckDB twins on the smallest tables (the
full comparison is scripts/oracle_check.py)."""

import datetime as dt
import importlib
import math

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
SMOKE = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["monthly_revenue_mom", "rfm_scores", "dq_gate", "pivot_category_month",
                                  "mann_whitney_u", "forecast_seasonal_naive", "cohort_pct_matrix",
                                  "model_selection", "published_forecast"])
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SMOKE)
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, res.fetchall())
