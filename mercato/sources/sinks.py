"""Result sinks (S4-S8) and the run-all driver.

Everything is written by the executors; only bounded samples are ever ordered into a
single partition (at most ``n`` rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path


def ordered(df: DataFrame, order: list[tuple[str, bool]] | None) -> DataFrame:
    if not order:
        return df
    cols = []
    for name, desc in order:
        c = F.abs(F.col("diff")) if name == "abs_diff" else F.col(name)
        cols.append(c.desc_nulls_first() if desc else c.asc_nulls_last())
    return df.orderBy(*cols)


def write_result(df: DataFrame, path: str, order: list[tuple[str, bool]] | None = None) -> None:
    """The whole result as CSV with a header, in the result's order over its files' names."""
    (ordered(df, order).write.mode("overwrite").option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


def write_result_sample(df: DataFrame, path: str, n: int,
                        order: list[tuple[str, bool]] | None = None) -> None:
    """The first ``n`` rows (in the result's order) as one CSV file with a header."""
    (ordered(df, order).limit(n).coalesce(1)
     .write.mode("overwrite").option("header", "true").csv(path))


def ctas_overwrite(df: DataFrame, path: str | None = None, table: str | None = None,
                   partition_by: list[str] | None = None) -> None:
    """Idempotent rebuild - overwrite a parquet path or a catalog table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(table)
    elif path:
        writer.parquet(path)
    else:
        raise ValueError("give a path or a table name")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register a (temporary) view."""
    df.createOrReplaceTempView(name)
    return df


def publish_forecast(forecast: DataFrame, table_path: str, csv_path: str | None = None) -> None:
    """The forecast as a typed table (series_id where there is one, date, forecast, lower,
    upper) and as CSV, range-sorted over as many files as Spark's partitions."""
    keys = [c for c in ("series_id",) if c in forecast.columns]
    typed = forecast.select(*keys, F.col("date").cast("date").alias("date"),
                            *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("forecast", "lower", "upper")])
    ctas_overwrite(typed, path=table_path)
    if csv_path:
        typed.orderBy(*keys, "date").write.mode("overwrite").option("header", "true").csv(csv_path)


def pivot_extract_sink(sales: DataFrame, out_dir: str) -> None:
    """The whole raw extract, in date order, and the two pivots as three CSV outputs.

    The sales lines are joined once, into a scratch table of the columns that the outputs read.
    """
    from ..operators.marts import pivot_category_month, pivot_state, sales_extract
    spark = sales.sparkSession
    place = scratch_path(spark, f"sales-{uuid.uuid4().hex}")
    lines = sales.select("order_id", "product_category_name_english", "customer_state", "order_date", "line_revenue")
    try:
        lines.write.option("compression", "zstd").parquet(place)
        sales = spark.read.schema(lines.schema).parquet(place)
        ext = sales_extract(sales).orderBy("order_date", "order_id")
        ext.write.mode("overwrite").option("header", "true").csv(f"{out_dir}/raw_extract")
        pivot_category_month(sales).coalesce(1).write.mode("overwrite").option("header", "true") \
            .csv(f"{out_dir}/category_month_pivot")
        pivot_state(sales).orderBy(F.desc("revenue")).coalesce(1).write.mode("overwrite") \
            .option("header", "true").csv(f"{out_dir}/state_pivot")
    finally:
        remove_path(spark, place)


def run_all_queries(results: dict[str, DataFrame], out_dir: str | None = None, sample_rows: int | None = None,
                    orders: dict[str, list[tuple[str, bool]]] | None = None) -> dict[str, DataFrame]:
    """Evaluate every business query in name order and write each result whole; with
    ``sample_rows``, also its first rows in the result's order below ``samples``."""
    for name in results:
        if out_dir:
            write_result(results[name], f"{out_dir}/{name}", (orders or {}).get(name))
            if sample_rows is not None:
                write_result_sample(results[name], f"{out_dir}/samples/{name}", sample_rows, (orders or {}).get(name))
    return results
