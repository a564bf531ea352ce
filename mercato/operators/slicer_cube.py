"""Exact distinct counts for any slicer selection, from a pre-aggregate.

Sums add up over slicer cells, distinct counts don't: an order lies in several categories, a
person in several months.  Each cell (month, state, category) therefore keeps the set of its
orders, and of its persons, as packed bitmaps; a selection merges the bitmaps of its cells by OR
and counts bits.  Orders and persons get a number once.  Numbers follow month and state, so the
32768 neighbours that share a bitmap lie in few cells and bitmaps are dense.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import from_cents
from ..functions.numeric import half_up_div
from ..session import scratch_path
from .marts import sales_extract

CELL = ["month", "state", "category"]
#: Counted things: name, the column that identifies one.
COUNTED = {"orders": "order_id", "customers": "customer_unique_id"}


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(cells: DataFrame, key: str) -> DataFrame:
    """(key, number): a number for each key, in the order of its first month and state.  Written,
    so that the numbers stay as they are."""
    first = cells.groupBy(key).agg(F.min(F.struct("month", "state")).alias("at"))
    placed = first.repartitionByRange("at", key).sortWithinPartitions("at", key)
    return _written(placed.select(key, F.monotonically_increasing_id().alias("number")), "numbers")


def build_cube(sales: DataFrame) -> DataFrame:
    """(counted, month, state, category, bucket, bits, cents): of each cell the bitmaps of its
    orders and persons (bucket: which 32768 numbers), and, with the orders, its revenue in cents
    (in the least bucket of the cell, so that it adds up)."""
    lines = sales_extract(sales).select("order_id", "month", "state", "category", "line_cents")
    people = sales.select("order_id", "customer_unique_id").distinct()
    members = lines.groupBy("order_id", *CELL).agg(F.sum("line_cents").alias("cents")).join(people, "order_id")
    members = _written(members, "cells")
    parts = []
    for counted, key in COUNTED.items():
        numbered = members.where(F.col(key).isNotNull()).join(_numbered(members.where(F.col(key).isNotNull()), key), key)
        parts.append(numbered.groupBy(*CELL, F.bitmap_bucket_number("number").alias("bucket"))
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
                          F.sum("cents" if counted == "orders" else F.lit(0)).alias("cents"))
                     .select(F.lit(counted).alias("counted"), *CELL, "bucket", "bits", "cents"))
    return parts[0].unionByName(parts[1])


def write_cube(sales: DataFrame, path: str) -> None:
    """The cube as files in folders of months, so that a range of months reads only those."""
    build_cube(sales).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path)


def read_cube(spark, path: str) -> DataFrame:
    return spark.read.schema("counted string, state string, category string, bucket long, bits binary, cents long, month string").parquet(path)


def select_kpis(cube: DataFrame, first: str | None = None, last: str | None = None, states: list[str] | None = None,
                categories: list[str] | None = None) -> DataFrame:
    """Revenue, distinct orders, distinct persons and average order value of a selection: months
    ``first`` to ``last`` ('yyyy-MM', both included), states, categories; None selects all."""
    if first:
        cube = cube.where(F.col("month") >= first)
    if last:
        cube = cube.where(F.col("month") <= last)
    if states:
        cube = cube.where(F.col("state").isin(states))
    if categories:
        cube = cube.where(F.col("category").isin(categories))
    merged = cube.groupBy("counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("cents").alias("cents"))
    count = lambda of: F.coalesce(F.sum(F.when(F.col("counted") == of, F.bitmap_count("bits"))), F.lit(0))
    total = merged.agg(F.sum("cents").alias("c"), count("orders").alias("total_orders"), count("customers").alias("customers"))
    return total.select(from_cents("c").alias("total_revenue"), "total_orders", "customers",
                        half_up_div(F.col("c"), F.col("total_orders") * F.lit(100), 2).alias("aov"))
