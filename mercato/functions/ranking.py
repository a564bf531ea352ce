"""Global ranking without a single-partition window.

``row_number()``/``ntile()`` over an unpartitioned window plan as ``Exchange
SinglePartition``: every row of the table goes through one task.  ``global_rank`` instead
range-partitions on the full (unique) sort key, so a hot sort value is split across
partitions, sorts each partition, saves the result with a reliable ``checkpoint()`` so
partition numbers and row order stay fixed, and adds to each row's position inside its
partition the number of rows in all earlier partitions.  Only one row per partition
(a count) is combined centrally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def global_rank(df: DataFrame, order_by: list[Column], rank_col: str = "rank",
                total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based dense position (row_number) over ``order_by`` across the whole frame.

    ``order_by`` must make rows unique (add a tiebreak column), otherwise the order of
    equal rows is arbitrary, as in any row_number.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    frozen = (df.repartitionByRange(n_parts, *order_by)
              .sortWithinPartitions(*order_by)
              .checkpoint(eager=True))
    pos = frozen.select(*cols, F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid"))
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most n_parts rows: a proven bound, so broadcasting it is safe
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(running) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    out = pos.join(F.broadcast(offsets), "_pid").select(
        *cols, (F.col("_off") + local + F.lit(1)).alias(rank_col), "_total")
    if total_col:
        return out.withColumnRenamed("_total", total_col)
    return out.drop("_total")


def ntile_from_rank(rank: Column, n: Column, k: int) -> Column:
    """SQL NTILE(k) of the row at 1-based position ``rank`` among ``n`` rows: the first
    ``n mod k`` tiles hold one row more than the rest."""
    q = F.floor(n / F.lit(k))
    r = n - q * F.lit(k)
    big = q + F.lit(1)
    head = F.floor((rank + big - F.lit(1)) / big)
    tail = r + F.floor((rank - r * big + q - F.lit(1)) / q)
    return F.when(rank <= r * big, head).otherwise(tail).cast("int")


def qcut_from_rank(rank: Column, n: Column, k: int) -> Column:
    """Quantile bin (1..k) of position ``rank`` among ``n`` distinct ranks, with bin edges
    at linearly interpolated quantiles and the lowest edge included (quantile-cut of a
    first-occurrence rank).  Bin sizes differ from NTILE when ``n mod k != 0``."""
    step = F.floor(((rank - F.lit(1)) * F.lit(k) + n - F.lit(2)) / (n - F.lit(1)))
    return (F.when(n <= F.lit(1), F.lit(1))
            .otherwise(F.greatest(F.lit(1), step)).cast("int"))


def global_cumsum(df: DataFrame, order_by: list[Column], weight: Column, out_col: str = "cumsum",
                  num_partitions: int | None = None) -> DataFrame:
    """Running (inclusive) sum of ``weight`` in ``order_by`` order across the whole frame.

    Same scheme as ``global_rank``: range partitions on a unique sort key, a reliable
    checkpoint, one total per partition, and a window confined to each partition (whose
    size the range partitioning bounds).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    frozen = (df.withColumn("_w", weight)
              .repartitionByRange(n_parts, *order_by)
              .sortWithinPartitions(*order_by)
              .checkpoint(eager=True))
    pos = frozen.select(*cols, "_w", F.spark_partition_id().alias("_pid"))
    totals = pos.groupBy("_pid").agg(F.sum("_w").alias("_tot"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select("_pid", (F.sum("_tot").over(running) - F.col("_tot")).alias("_off"))
    local = F.sum("_w").over(Window.partitionBy("_pid").orderBy(*order_by)
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (pos.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_off") + local).alias(out_col)))
