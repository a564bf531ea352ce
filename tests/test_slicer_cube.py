"""Any slicer selection from the bitmaps equals the measures over the item lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import marts, slicer_cube


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(4)
    rows = []
    for o in range(400):  # an order's lines lie in several categories
        day = dt.date(2019, 11, 1) + dt.timedelta(rng.randint(0, 150))
        state, person = rng.choice(["SP", "RJ", None]), rng.choice([None, *(f"p{i}" for i in range(90))])
        for _ in range(rng.randint(1, 4)):
            rows.append((f"o{o}", rng.choice(["toys", "food", None, "art"]), state, person, day, f"{rng.randint(0, 9999) / 100:.2f}"))
    return spark.createDataFrame(rows, "order_id string, product_category_name_english string, customer_state string, "
                                       "customer_unique_id string, order_date date, line_revenue string").withColumn(
        "line_revenue", F.col("line_revenue").cast("decimal(18,2)"))


@pytest.fixture(scope="module")
def cube(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube") / "cube")
    slicer_cube.write_cube(sales, path)
    return slicer_cube.read_cube(spark, path)


@pytest.mark.parametrize("chosen", [
    {}, {"first": "2020-01"}, {"first": "2019-12", "last": "2020-02", "states": ["SP"]}, {"categories": ["toys", "unknown"]},
    {"last": "2019-11", "states": ["RJ", "SP"], "categories": ["art", "food"]}, {"states": ["nowhere"]}])
def test_selection(sales, cube, chosen):
    got = slicer_cube.select_kpis(cube, **chosen).first()
    start, end = chosen.get("first"), chosen.get("last")
    lines = sales.where(F.date_format("order_date", "yyyy-MM").between(start or "0000-00", end or "9999-99"))
    lines = marts.apply_slicers(lines, states=chosen.get("states"), categories=chosen.get("categories"))
    want = marts.kpi_revenue(lines).first()
    assert (got["total_revenue"], got["total_orders"], got["aov"]) == (want["total_revenue"], want["total_orders"], want["aov"])
    assert got["customers"] == lines.select("customer_unique_id").where("customer_unique_id IS NOT NULL").distinct().count()


def test_a_range_reads_only_its_months(cube):
    plan = slicer_cube.select_kpis(cube, first="2020-01", last="2020-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
