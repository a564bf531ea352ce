"""Packed daily series against plain lists."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import packed_series as ps
from mercato.operators.star import Star


def test_series_of_keys(spark):
    rng = random.Random(9)
    first = dt.date(2020, 1, 1)
    orders = [(f"c{rng.randint(0, 9)}", dt.datetime(2020, 1, 1) + dt.timedelta(rng.choice([0, 59, rng.randint(0, 59)]), 3600)) for _ in range(150)]
    orders += [("c0", dt.datetime(2020, 1, 1)), ("c0", dt.datetime(2020, 2, 29)), ("c0", None)]
    star = Star({})
    star.bind("fact_orders", spark.createDataFrame(orders, "customer_id string, order_purchase_timestamp timestamp_ntz"))
    star.bind("dim_customers", spark.createDataFrame([(f"c{i}", [None, "SP", "RJ"][i % 3]) for i in range(10)], "customer_id string, customer_state string"))
    rows = ps.packed_series(star, "customer_state").withColumns({"lift": ps.lifts(), "naive": ps.naive_forecast()})
    got = {r["series_id"]: r for r in rows.collect()}
    days = {(r["series_id"], r["day"], r["day_index"], r["orders"]) for r in ps.unpacked(ps.packed_series(star, "customer_state")).collect()}
    assert days == {(k, first + dt.timedelta(i), i, n) for k, r in got.items() for i, n in enumerate(r["orders"])}
    assert set(got) == {None, "SP", "RJ"}
    for key, r in got.items():
        want = [0] * 60
        for c, at in orders:
            if at and [None, "SP", "RJ"][int(c[1:]) % 3] == key:
                want[(at.date() - first).days] += 1
        assert r["first_day"] == first and r["orders"] == want
        for i, lift in enumerate(r["lift"]):
            before = want[max(0, i - 14): i]
            assert lift == (pytest.approx(want[i] * len(before) / sum(before)) if sum(before) else None)
        assert r["naive"] == [want[53 + s % 7] for s in range(28)]


def test_short_series_have_no_forecast(spark):
    df = spark.range(1).select(F.array([F.lit(x).cast("long") for x in (1, 2, 3)]).alias("orders"))
    assert df.select(ps.naive_forecast().alias("f")).first()["f"] is None
