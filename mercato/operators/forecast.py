"""Daily demand forecast with a walk-forward backtest.

The series is a daily count of placed orders, optionally one per key (``by``).  Folds
are a handful of rows per series; the seasonal-naive forecast is an equi-join on the
day index; Holt-Winters is fitted per (series, fold) with ``applyInPandas`` (each group
is one daily series, bounded by the calendar).  Metrics, the winner and the interval are
aggregates and joins on those small frames.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import holt_winters
from ..session import ensure_checkpoint_dir, ship_package
from .eda import purchase_date_bounds
from .star import Star

HORIZON = 28
N_FOLDS = 6
SEASON = 7
SN, HW = "seasonal_naive", "holt_winters"


def daily_series(star: Star, start: str | None = None, end: str | None = None,
                 by: str | None = None, fill_missing: bool = True) -> DataFrame:
    """(series_id, day, day_index, orders) for every calendar day in [start, end].

    Days without orders are 0 when ``fill_missing`` (else NULL, which ``assert_no_gaps``
    rejects).  Bounds default to the first and last purchase day.
    """
    orders = star.fact_orders
    if by:
        orders = orders.join(star.dim_customers.select("customer_id", by), "customer_id")
    key = F.col(by).cast("string") if by else F.lit("all")
    if start and end:
        bounds = orders.sparkSession.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                                     F.to_date(F.lit(end)).alias("end"))
    else:
        bounds = purchase_date_bounds(star)
    day = F.to_date("order_purchase_timestamp")
    counts = (orders.crossJoin(F.broadcast(bounds))
              .filter((day >= F.col("start")) & (day <= F.col("end")))
              .groupBy(key.alias("series_id"), day.alias("day"))
              .agg(F.count(F.lit(1)).alias("orders")))
    keys = counts.select("series_id").distinct()
    spine = (bounds.select("start", F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("day"))
             .crossJoin(keys))
    filled = F.coalesce("orders", F.lit(0)) if fill_missing else F.col("orders")
    return (spine.join(counts, ["series_id", "day"], "left")
            .select("series_id", "day", F.date_diff("day", "start").alias("day_index"),
                    filled.cast("bigint").alias("orders")))


def assert_no_gaps(series: DataFrame) -> None:
    """Raise if a day of the series has no value (the one aggregate reaches the driver)."""
    missing = series.filter(F.col("orders").isNull()).count()
    if missing:
        raise ValueError(f"{missing} gap days in the series window")


def event_lift(series: DataFrame, window_days: int = 14, folds: DataFrame | None = None) -> DataFrame:
    """Each day's orders against the mean of the ``window_days`` days before it,
    and (with ``folds``) the days from that day to the first test fold."""
    w = (Window.partitionBy("series_id").orderBy("day_index")
         .rangeBetween(-window_days, -1))
    base = F.avg("orders").over(w)
    out = series.select("series_id", "day", "orders", F.round(base, 9).alias("baseline_avg"),
                        F.round(F.try_divide(F.col("orders").cast("double"), base), 9).alias("lift"))
    if folds is not None:
        first = folds.groupBy("series_id").agg(F.min("test_start").alias("_first"))
        out = out.join(first, "series_id", "left").select(
            *out.columns, F.date_diff("_first", "day").alias("days_before_first_fold"))
    return out


def walk_forward_folds(series: DataFrame, n_folds: int = N_FOLDS, horizon: int = HORIZON) -> DataFrame:
    """N16e: expanding-origin folds; fold f tests the ``horizon`` days starting
    ``(n_folds - f + 1) * horizon`` days before the series end and trains on all before.
    A series that leaves a fold less than one season to train on raises."""
    spark = series.sparkSession
    length = series.groupBy("series_id").agg(F.count(F.lit(1)).alias("_len"),
                                             F.min("day").alias("_first_day"))
    folds = spark.range(1, n_folds + 1).select(F.col("id").cast("int").alias("fold"))
    start_idx = F.col("_len") - (F.lit(n_folds) - F.col("fold") + 1) * F.lit(horizon)
    short = F.format_string(f"series %s has %s days, {n_folds} folds need {n_folds * horizon + SEASON}", "series_id", "_len")
    start_idx = F.when(start_idx >= SEASON, start_idx).otherwise(F.raise_error(short).cast("bigint"))
    return (length.crossJoin(F.broadcast(folds))
            .select("series_id", "fold", start_idx.alias("test_start_idx"),
                    F.date_add("_first_day", start_idx.cast("int")).alias("test_start"),
                    F.date_add("_first_day", (start_idx + horizon - 1).cast("int")).alias("test_end")))


def seasonal_naive_predictions(series: DataFrame, folds: DataFrame,
                               horizon: int = HORIZON) -> DataFrame:
    """N16c per fold and test day: actual and the value observed on the same weekday of
    the last training week (a pure equi-join on the day index)."""
    test_days = folds.select("series_id", "fold", "test_start_idx",
                             F.explode(F.sequence(F.col("test_start_idx"),
                                                  F.col("test_start_idx") + horizon - 1)).alias("day_index"))
    src = F.col("test_start_idx") - SEASON + (F.col("day_index") - F.col("test_start_idx")) % SEASON
    keyed = test_days.select("series_id", "fold", "day_index", src.alias("src_index"))
    actual = series.select("series_id", "day_index", "day", F.col("orders").alias("actual"))
    past = series.select("series_id", F.col("day_index").alias("src_index"),
                         F.col("orders").cast("double").alias("forecast"))
    return (keyed.join(actual, ["series_id", "day_index"])
            .join(past, ["series_id", "src_index"])
            .select("series_id", "fold", "day", "day_index", "actual", "forecast"))


_HW_SCHEMA = "series_id string, fold int, step int, forecast double"


def _hw_group(horizon: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day_index")
        fc = holt_winters.forecast(pdf["orders"].to_numpy(dtype=float), horizon, SEASON)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "fold": int(pdf["fold"].iloc[0]),
                             "step": range(horizon), "forecast": fc})
    return run


def holt_winters_predictions(series: DataFrame, folds: DataFrame, horizon: int = HORIZON,
                             include_final: bool = True) -> DataFrame:
    """N16d: Holt-Winters fitted on each fold's training days (fold 0 = the whole series,
    for the final forecast); returns (series_id, fold, step, forecast)."""
    ship_package(series.sparkSession)  # the group function lives in this package
    f = folds.select("series_id", "fold", "test_start_idx")
    if include_final:
        final = series.groupBy("series_id").agg(F.count(F.lit(1)).alias("test_start_idx"))
        f = f.unionByName(final.select("series_id", F.lit(0).alias("fold"), "test_start_idx"))
    train = (series.join(f, "series_id")
             .filter(F.col("day_index") < F.col("test_start_idx"))
             .select("series_id", "fold", "day_index", F.col("orders").cast("double").alias("orders")))
    # a fit is much work on few bytes: a stated number of tasks, as AQE would put all groups into one
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    train = train.repartition(tasks, "series_id", "fold")
    return train.groupBy("series_id", "fold").applyInPandas(_hw_group(horizon), _HW_SCHEMA)


def holt_winters_backtest_predictions(series: DataFrame, folds: DataFrame, hw: DataFrame) -> DataFrame:
    actual = series.select("series_id", "day_index", "day", F.col("orders").alias("actual"))
    keyed = hw.filter(F.col("fold") > 0).join(folds.select("series_id", "fold", "test_start_idx"),
                                              ["series_id", "fold"])
    return (keyed.withColumn("day_index", F.col("test_start_idx") + F.col("step"))
            .join(actual, ["series_id", "day_index"])
            .select("series_id", "fold", "day", "day_index", "actual", "forecast"))


def fold_metrics(preds: DataFrame, model: str) -> DataFrame:
    """N16a/N16b per fold: WAPE = sum|a-f| / sum|a| and bias = mean(f - a)."""
    return preds.groupBy("series_id", "fold").agg(
        F.min("day").alias("test_start"), F.max("day").alias("test_end"),
        F.try_divide(F.sum(F.abs(F.col("actual") - F.col("forecast"))),
                     F.sum(F.abs(F.col("actual")))).alias("wape"),
        F.avg(F.col("forecast") - F.col("actual")).alias("bias"),
    ).withColumn("model", F.lit(model))


class Backtest:
    """All backtest frames for one series frame (lazy; HW fitted once per fold)."""

    def __init__(self, series: DataFrame, n_folds: int = N_FOLDS, horizon: int = HORIZON):
        # the series (days x series keys, small) feeds about ten joins below: save it once
        # to the reliable checkpoint folder rather than re-aggregating orders in each
        ensure_checkpoint_dir(series.sparkSession)
        series = series.checkpoint(eager=True)
        self.series, self.horizon = series, horizon
        self.folds = walk_forward_folds(series, n_folds, horizon)
        self.sn_preds = seasonal_naive_predictions(series, self.folds, horizon)
        # the fits feed both the backtest and the final forecast: save them once to the
        # reliable checkpoint folder instead of refitting in every consumer
        ensure_checkpoint_dir(series.sparkSession)
        self.hw_all = holt_winters_predictions(series, self.folds, horizon).checkpoint(eager=True)
        self.hw_preds = holt_winters_backtest_predictions(series, self.folds, self.hw_all)

    def metrics(self) -> DataFrame:
        return fold_metrics(self.sn_preds, SN).unionByName(fold_metrics(self.hw_preds, HW))

    def table(self) -> DataFrame:
        """N16f: one row per fold with both models' WAPE and bias."""
        m = self.metrics()
        return (m.groupBy("series_id", "fold", "test_start", "test_end")
                .agg(F.max(F.when(F.col("model") == SN, F.col("wape"))).alias("wape_seasonal_naive"),
                     F.max(F.when(F.col("model") == HW, F.col("wape"))).alias("wape_holt_winters"),
                     F.max(F.when(F.col("model") == SN, F.col("bias"))).alias("bias_seasonal_naive"),
                     F.max(F.when(F.col("model") == HW, F.col("bias"))).alias("bias_holt_winters")))

    def selection(self) -> DataFrame:
        """N16g: mean WAPE/bias per model; Holt-Winters wins only if strictly better."""
        t = self.table()
        s = t.groupBy("series_id").agg(*[F.avg(c).alias(f"mean_{c}") for c in (
            "wape_seasonal_naive", "wape_holt_winters", "bias_seasonal_naive", "bias_holt_winters")])
        return s.select("*",
                        F.when(F.col("mean_wape_holt_winters") < F.col("mean_wape_seasonal_naive"), F.lit(HW))
                        .otherwise(F.lit(SN)).alias("winner"),
                        (F.try_divide(F.col("mean_wape_seasonal_naive") - F.col("mean_wape_holt_winters"),
                                      F.col("mean_wape_seasonal_naive")) * 100).alias("lift_pct"))

    def forecast(self) -> DataFrame:
        """The winner's next-``horizon``-day forecast with an empirical 95% band from
        the winner's pooled backtest residuals (lower floored at 0)."""
        sel = self.selection().select("series_id", "winner")
        resid = (self.sn_preds.withColumn("model", F.lit(SN))
                 .unionByName(self.hw_preds.withColumn("model", F.lit(HW)))
                 .join(sel, "series_id").filter(F.col("model") == F.col("winner"))
                 .groupBy("series_id")
                 .agg(F.percentile(F.col("actual") - F.col("forecast"), [0.025, 0.975]).alias("_q")))
        future = seasonal_naive_future(self.series, self.horizon).join(
            self.hw_all.filter(F.col("fold") == 0).select("series_id", "step", F.col("forecast").alias("_hw")),
            ["series_id", "step"])
        point = F.when(F.col("winner") == HW, F.col("_hw")).otherwise(F.col("_sn"))
        return (future.join(sel, "series_id").join(resid, "series_id")
                .select("series_id", "date", point.alias("forecast"), "winner",
                        F.greatest(point + F.col("_q")[0], F.lit(0.0)).alias("lower"),
                        (point + F.col("_q")[1]).alias("upper")))

    def thresholds(self) -> DataFrame:
        """Investigate limits from the winner's fold spread - mean + 1 sd of fold WAPE
        and of |bias| - and whether the latest fold breaches them."""
        m = self.metrics().join(self.selection().select("series_id", "winner"), "series_id") \
            .filter(F.col("model") == F.col("winner"))
        latest = Window.partitionBy("series_id").orderBy(F.desc("fold"))
        lim = m.groupBy("series_id", "winner").agg(
            F.avg("wape").alias("wape_mean"), F.stddev_samp("wape").alias("wape_sd"),
            F.avg(F.abs("bias")).alias("abs_bias_mean"), F.stddev_samp(F.abs("bias")).alias("abs_bias_sd"))
        last = m.withColumn("_r", F.row_number().over(latest)).filter(F.col("_r") == 1) \
            .select("series_id", F.col("wape").alias("last_wape"), F.col("bias").alias("last_bias"))
        out = lim.join(last, "series_id").select(
            "series_id", "winner",
            (F.col("wape_mean") + F.col("wape_sd")).alias("wape_threshold"),
            (F.col("abs_bias_mean") + F.col("abs_bias_sd")).alias("abs_bias_threshold"),
            "last_wape", "last_bias")
        return out.select("*",
                          (F.col("last_wape") > F.col("wape_threshold")).alias("wape_breach"),
                          (F.abs("last_bias") > F.col("abs_bias_threshold")).alias("bias_breach"))


def seasonal_naive_future(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The last observed week repeated over the next ``horizon`` days:
    (series_id, step, date, _sn)."""
    spark = series.sparkSession
    end = series.groupBy("series_id").agg(F.max("day_index").alias("_last_idx"), F.max("day").alias("_last_day"))
    steps = spark.range(horizon).select(F.col("id").cast("int").alias("step"))
    src = F.col("_last_idx") - SEASON + 1 + F.col("step") % SEASON
    keyed = end.crossJoin(F.broadcast(steps)).select(
        "series_id", "step", F.date_add("_last_day", F.col("step") + 1).alias("date"), src.alias("src_index"))
    past = series.select("series_id", F.col("day_index").alias("src_index"),
                         F.col("orders").cast("double").alias("_sn"))
    return keyed.join(past, ["series_id", "src_index"]).select("series_id", "step", "date", "_sn")


def seasonal_naive_forecast(series: DataFrame, n_folds: int = N_FOLDS, horizon: int = HORIZON) -> DataFrame:
    """N17 for the seasonal-naive model alone: forecast and empirical band from its own
    backtest residuals (the published forecast whenever Holt-Winters does not win)."""
    folds = walk_forward_folds(series, n_folds, horizon)
    preds = seasonal_naive_predictions(series, folds, horizon)
    q = preds.groupBy("series_id").agg(
        F.percentile(F.col("actual") - F.col("forecast"), [0.025, 0.975]).alias("_q"))
    fut = seasonal_naive_future(series, horizon).join(q, "series_id")
    return fut.select("series_id", "date", F.col("_sn").alias("forecast"),
                      F.round(F.greatest(F.col("_sn") + F.col("_q")[0], F.lit(0.0)), 6).alias("lower"),
                      F.round(F.col("_sn") + F.col("_q")[1], 6).alias("upper"))


def forecast_total(forecast: DataFrame) -> DataFrame:
    """Sums of the daily point forecasts and of the daily bounds (the bound sums
    are not an interval for the total)."""
    return forecast.groupBy("series_id").agg(
        F.sum("forecast").alias("forecast_total"),
        F.sum("lower").alias("sum_of_daily_lower"),
        F.sum("upper").alias("sum_of_daily_upper"))
