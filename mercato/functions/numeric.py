"""Exact rounded ratios.

The model rounds ratios of exact numbers (counts, money) half away from zero, as exact
decimal arithmetic does.  Spark's decimal division may cut the scale to 6 digits under
precision pressure and double arithmetic may sit on either side of a tie, so ratios are
formed here in integral DECIMAL(38,0) arithmetic: ``q = (2*|n|*10^s + |d|) div (2*|d|)``
with the sign of ``n*d``, returned as ``q / 10^s`` in DOUBLE.  The result is the double
nearest to the correctly rounded decimal, whatever engine computes it the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def unscaled(col: Column | str, scale: int = 2) -> Column:
    """A decimal with ``scale`` digits as the integral count of its smallest unit."""
    c = F.col(col) if isinstance(col, str) else col
    return (c * F.lit(10 ** scale)).cast(_INT)


def half_up_div(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale), half away from zero, for integral-valued columns.

    NULL when either side is NULL or ``den`` is zero.
    """
    n = num.cast(_INT)
    d = F.when(den.cast(_INT) != 0, den.cast(_INT))
    an, ad = F.abs(n), F.abs(d)
    top = (an * F.lit(2 * 10 ** scale) + ad).cast(_INT)
    bottom = (ad * F.lit(2)).cast(_INT)
    # exact integral quotient: subtract the remainder, then divide a multiple
    q = ((top - top % bottom) / bottom).cast(_INT)
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    return (q * sign).cast("double") / F.lit(float(10 ** scale))


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """round(100 * num / den, scale) for integral-valued columns."""
    return half_up_div(num.cast(_INT) * F.lit(100), den, scale)
