import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions.ranking import global_cumsum, global_rank, ntile_from_rank, qcut_from_rank


def test_global_rank_matches_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 30), f"p{i:05d}") for i in range(2003)]  # many ties in k
    df = spark.createDataFrame(data, "k int, person string")
    got = global_rank(df, [F.col("k"), F.col("person")], "r", total_col="n", num_partitions=7)
    want = df.withColumn("r", F.row_number().over(Window.orderBy("k", "person")))
    a = {(r.person, r.r) for r in got.collect()}
    b = {(r.person, r.r) for r in want.collect()}
    assert a == b
    assert {r.n for r in got.select("n").distinct().collect()} == {2003}


def test_global_rank_descending_and_hot_value(spark):
    data = [(1 if i % 3 else i, f"p{i:05d}") for i in range(900)]  # one value holds 2/3 of rows
    df = spark.createDataFrame(data, "k int, person string")
    got = global_rank(df, [F.col("k").desc(), F.col("person")], "r", num_partitions=5)
    want = df.withColumn("r", F.row_number().over(Window.orderBy(F.col("k").desc(), "person")))
    assert {(r.person, r.r) for r in got.collect()} == {(r.person, r.r) for r in want.collect()}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 10, 13, 23])
def test_ntile_formula(spark, n):
    df = spark.range(1, n + 1).withColumnRenamed("id", "r")
    got = df.select("r", ntile_from_rank(F.col("r"), F.lit(n), 5).alias("t"),
                    F.ntile(5).over(Window.orderBy("r")).alias("want"))
    assert all(row.t == row.want for row in got.collect())


@pytest.mark.parametrize("n", [2, 3, 7, 10, 13, 93])
def test_qcut_formula_matches_pandas(spark, n):
    ranks = pd.Series(range(1, n + 1), dtype=float)
    want = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    df = spark.range(1, n + 1).withColumnRenamed("id", "r")
    got = [r.q for r in df.select(qcut_from_rank(F.col("r"), F.lit(n), 5).alias("q")).orderBy("r").collect()]
    assert got == want


def test_global_cumsum(spark):
    data = [(i, (i * 7) % 11) for i in range(500)]
    df = spark.createDataFrame(data, "v int, w int")
    got = {r.v: r.c for r in global_cumsum(df, [F.col("v")], F.col("w"), "c", num_partitions=6).collect()}
    run = 0
    for v, w in data:
        run += w
        assert got[v] == run
