"""Tiles by selection against window functions, with ties, nulls, odd ids and few rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions.tiles import ntile_positions, qcut_positions, tile_columns
from mercato.session import scratch_path

BIG = (1 << 63) - 1


def people(seed, n, kind):
    rng = random.Random(seed)
    if kind == "text":
        ids = {"".join(rng.choice(["a", "b", "é", "日", "0", "~"]) for _ in range(rng.randint(0, 17))) for _ in range(3 * n)}
    else:
        ids = {rng.choice([rng.randint(-BIG - 1, BIG), rng.randint(0, 50), -BIG - 1, BIG]) for _ in range(3 * n)}
    ids = sorted(ids)[:n] if len(ids) >= n else sorted(ids)
    rng.shuffle(ids)
    return [(i, rng.choice([None, 0, 1, -5, rng.randint(-10**12, 10**12), rng.randint(0, 3)])) for i in ids]


@pytest.mark.parametrize("kind, n", [("text", 400), ("text", 3), ("long", 400), ("long", 1), ("long", 7)])
def test_ntile(spark, kind, n):
    rows = people(n, n, kind)
    df = spark.createDataFrame(rows, f"person {'string' if kind == 'text' else 'long'}, v long").repartition(3)
    columns = tile_columns(df, "person", {"five": (F.col("v"), lambda n: ntile_positions(n, 5)),
                                          "minus": (-F.col("v"), lambda n: ntile_positions(n, 4))})
    by = lambda c: Window.orderBy(c.asc_nulls_last(), "person")
    got = df.select("*", columns["five"].alias("five"), columns["minus"].alias("minus"),
                    F.ntile(5).over(by(F.col("v"))).alias("a"), F.ntile(4).over(by(-F.col("v"))).alias("b")).collect()
    assert len(got) == len(rows) and all(r["five"] == r["a"] and r["minus"] == r["b"] for r in got)


@pytest.mark.parametrize("n", [1, 2, 4, 7, 93])
def test_quantile_cut(spark, n):
    df = spark.range(n).select(F.col("id").alias("person"), (F.col("id") * 7 % 5).alias("v"))
    tile = tile_columns(df, "person", {"q": (F.col("v"), lambda n: qcut_positions(n, 5))})["q"]
    got = [r["q"] for r in df.select("*", tile.alias("q")).orderBy("v", "person").collect()]
    want = pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=False).add(1).tolist() if n > 1 else [1]
    assert got == want


def test_no_rows(spark):
    df = spark.createDataFrame([], "person string, v long")
    assert df.select(tile_columns(df, "person", {"t": (F.col("v"), lambda n: ntile_positions(n, 5))})["t"]).collect() == []


def test_neither_sort_nor_files_are_left(spark):
    df = spark.range(3000).select(F.col("id").alias("person"), (F.col("id") % 2).alias("v"))  # one value, half of all rows
    column = tile_columns(df, "person", {"t": (F.col("v"), lambda n: ntile_positions(n, 5))})["t"]
    plan = df.select("person", column.alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    assert not [n for n in names if n.startswith("tiles-")]
