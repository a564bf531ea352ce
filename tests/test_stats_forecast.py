import functools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from mercato.functions import holt_winters
from mercato.operators import forecast as fc
from mercato.operators import stats


def _mwu_brute(late, on_time):
    u = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in late for b in on_time)
    n1, n2 = len(late), len(on_time)
    allv = late + on_time
    ties = sum(c ** 3 - c for c in (allv.count(v) for v in set(allv)))
    n = n1 + n2
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (u - n1 * n2 / 2 + 0.5) / sd
    return u, z, 0.5 * math.erfc(-z / math.sqrt(2))


def test_rank_sum_matches_pair_counting(spark):
    rnd = random.Random(3)
    late = [rnd.randint(1, 5) for _ in range(60)]
    on_time = [min(5, rnd.randint(1, 5) + 1) for _ in range(140)]
    df = spark.createDataFrame([(v, True) for v in late] + [(v, False) for v in on_time],
                               "review_score int, is_late boolean")
    parts = stats.rank_sum_parts(df, "review_score", "is_late")
    res = stats.mann_whitney_from_parts(parts).first()
    u, z, p = _mwu_brute(late, on_time)
    assert res.u_statistic == u
    assert abs(res.z - z) < 1e-8
    erfc = F.expr("java_method('org.apache.commons.math3.special.Erf', 'erfc', CAST(x AS DOUBLE))")
    got_p = spark.createDataFrame([(-res.z / math.sqrt(2),)], "x double").select(erfc.cast("double")).first()[0] / 2
    assert abs(got_p - 0.5 * math.erfc(-res.z / math.sqrt(2))) < 1e-15  # JVM erfc = Python erfc
    assert abs(got_p - p) < 1e-8  # z is reported to 9 decimals


def _series(spark, values):
    rows = [("all", i, int(v)) for i, v in enumerate(values)]
    return (spark.createDataFrame(rows, "series_id string, day_index int, orders long")
            .withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day_index"))))


def test_seasonal_naive_matches_tiling(spark):
    rnd = random.Random(1)
    y = [rnd.randint(0, 50) for _ in range(300)]
    s = _series(spark, y)
    folds = fc.walk_forward_folds(s)
    preds = fc.seasonal_naive_predictions(s, folds)
    got = {(r.fold, r.day_index): r.forecast for r in preds.collect()}
    for f in range(1, 7):
        start = 300 - (6 - f + 1) * 28
        tiled = np.tile(np.array(y[start - 7:start]), 4)
        for j in range(28):
            assert got[(f, start + j)] == tiled[j]
    future = {r.step: r._sn for r in fc.seasonal_naive_future(s).collect()}
    assert [future[k] for k in range(28)] == list(np.tile(np.array(y[-7:]), 4).astype(float))


def test_holt_winters_recovers_a_clean_pattern():
    t = np.arange(200)
    y = 100 + 0.5 * t + np.tile([5, -3, 0, 2, 8, -10, -2], 40)[:200]
    f = holt_winters.forecast(y, 14)
    want = 100 + 0.5 * np.arange(200, 214) + np.tile([5, -3, 0, 2, 8, -10, -2], 40)[200:214]
    assert np.max(np.abs(f - want)) < 1.0


def test_backtest_frames(spark):
    rnd = random.Random(5)
    y = [20 + 5 * (i % 7 == 5) + rnd.randint(0, 4) for i in range(260)]
    bt = fc.Backtest(_series(spark, y))
    table = bt.table().collect()
    assert len(table) == 6
    sel = bt.selection().first()
    assert sel.winner in (fc.SN, fc.HW)
    out = bt.forecast().collect()
    assert len(out) == 28 and all(r.lower <= r.forecast <= r.upper and r.lower >= 0 for r in out)


def test_many_series_are_fitted_as_each_alone(spark):
    rnd = random.Random(8)
    values = {"a": [30 + 9 * (i % 7 == 2) + i // 20 + rnd.randint(0, 3) for i in range(230)],
              "b": [rnd.randint(0, 40) for _ in range(230)], "c": [0] * 230}
    both = functools.reduce(lambda x, y: x.unionByName(y), (_series(spark, v).withColumn("series_id", F.lit(k)) for k, v in values.items()))
    bt = fc.Backtest(both)
    got = {}
    for r in sorted(bt.hw_all.collect(), key=lambda r: r.step):
        got.setdefault((r.series_id, r.fold), []).append(r.forecast)
    for k, v in values.items():
        for fold in range(7):
            train = v if fold == 0 else v[: 230 - (7 - fold) * 28]
            assert np.allclose(got[k, fold], holt_winters.forecast(np.array(train, float), 28), atol=1e-9)
    rows = {r.series_id: r for r in bt.selection().collect()}
    assert rows["a"].winner == fc.HW  # level, trend and season are there
    assert rows["c"].winner == fc.SN and rows["c"].mean_wape_holt_winters is None  # nothing to divide by
