"""Plan properties that matter at scale (checked on the physical plan text)."""

import re

from pyspark.sql import functions as F

from mercato.functions.ranking import global_rank
from mercato.operators import star

SMOKE = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_rank_gathers_only_partition_counts(spark):
    df = spark.range(5000).select((F.col("id") % 17).alias("k"), F.col("id").alias("person"))
    ranked = global_rank(df, [F.col("k"), F.col("person")], "r", num_partitions=6)
    lines = _plan(ranked).splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i:i + 4])
            assert re.search(r"HashAggregate\(keys=\[_pid", below), below


def test_translation_join_is_broadcast(spark):
    from mercato.plans.model import from_testdata
    m = from_testdata(spark, SMOKE)
    plan = _plan(m.star.dim_products)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_review_dedup_combines_map_side(spark):
    from mercato.plans.model import from_testdata
    m = from_testdata(spark, SMOKE)
    plan = _plan(m.star.order_reviews)
    assert "partial_min_by" in plan and "Window" not in plan


def test_revenue_sums_stay_on_longs(spark):
    from mercato.operators import analysis
    from mercato.plans.model import from_testdata
    m = from_testdata(spark, SMOKE)
    plan = _plan(analysis.monthly_revenue_mom(m.star))
    sums = re.findall(r"partial_sum\(([^)]*)", plan)
    assert sums and all("decimal" not in s for s in sums)
