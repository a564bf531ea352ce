"""Column expressions shared by the operators (pure JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DELIVERED = "delivered"
CANCELED = "canceled"


def is_delivered(col: str = "order_status") -> Column:
    return F.col(col) == F.lit(DELIVERED)


def line_revenue() -> Column:
    """Revenue of an item line: price + freight."""
    return F.col("price") + F.col("freight_value")


def month_start(ts: str | Column) -> Column:
    """First day of the month of a zone-free timestamp, as a DATE."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(F.to_date(c), "month")


def month_label(d: str | Column) -> Column:
    """'yyyy-MM' label of a date."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, "yyyy-MM")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months between two month-start dates."""
    return ((F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))).cast("int")


def frequency_bucket(freq: Column) -> Column:
    """1 / 2 / 3+ order-count bucket."""
    return F.when(freq == 1, 1).when(freq == 2, 2).otherwise(3).cast("int")


# The four segment labels.
CHAMPIONS = "Champions (repeat, recent)"
AT_RISK_REPEAT = "At-Risk Repeat (repeat, not recent)"
RECENT_ONE_TIME = "Recent One-Time (acquisition pool)"
LAPSED_ONE_TIME = "Lapsed One-Time"


def segment_label(f_bucket: Column, r_score: Column) -> Column:
    """Business segment of a (frequency bucket, recency score) pair."""
    return (F.when((f_bucket >= 2) & (r_score >= 4), CHAMPIONS)
            .when((f_bucket >= 2) & (r_score <= 3), AT_RISK_REPEAT)
            .when((f_bucket == 1) & (r_score >= 4), RECENT_ONE_TIME)
            .otherwise(LAPSED_ONE_TIME))


def cents(col: str | Column) -> Column:
    """A DECIMAL(18,2) money value as exact BIGINT cents.

    Sums of DECIMAL(18,2) widen past 18 digits and fall back to arbitrary-precision
    arithmetic; cents keep every aggregate on primitive longs.  The conversion is a decimal
    product, exact for every DECIMAL(18,2); sums stay exact up to 9.2e16 currency units.
    """
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("decimal(18,2)") * F.lit(100)).cast("long")


def line_revenue_cents() -> Column:
    """price + freight of an item line in cents."""
    return cents("price") + cents("freight_value")


def from_cents(col: str | Column) -> Column:
    """Cents back to an exact DECIMAL(38,2) (applied to aggregated rows only)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")
