"""Order-free hashes of a frame's columns, to compare results between engines and files.

A value's text is made alike first: numbers (and text that reads as one) are rounded to four
decimals, dates and times written to the microsecond.  The hash is the first 32 bits of its MD5,
and a column's hash is their sum: it does not depend on row order or partitioning and combines
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of at least this size are compared as text.
_LARGEST = 1e14
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


#: Text that may read as a number (a failing cast costs an exception each, so most text is kept from it).
_NUMBER = r"^\s*[-+]?[0-9]*\.?[0-9]*([eE][-+]?[0-9]+)?\s*$"
_TIME = r"^[0-9]{4}-"


def _rounded(number: Column, text: Column) -> Column:
    inside = number.between(-_LARGEST, _LARGEST)
    return F.when(inside, F.round(F.when(inside, number) * 10000).cast("long").cast("string")).otherwise(text)


def canonical(column: str, kind: T.DataType) -> Column:
    """The text that stands for a value; NULL is a tilde."""
    value = F.col(f"`{column}`")
    text = value.cast("string")
    if isinstance(kind, T.NumericType):
        found = _rounded(value.cast("double"), text)
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        found = F.date_format(value.cast("timestamp_ntz"), _MICROS)
    elif isinstance(kind, T.StringType):
        time = F.when(value.rlike(_TIME) & (F.length(value) >= 10), value.try_cast("timestamp_ntz"))
        found = (F.when(value.rlike(_NUMBER), _rounded(value.try_cast("double"), text))
                 .otherwise(F.coalesce(F.date_format(time, _MICROS), text)))
    else:
        found = text
    return F.coalesce(found, F.when(value.isNull(), "~").otherwise(text))


def _hash(column: str, kind: T.DataType) -> Column:
    return F.conv(F.substring(F.md5(canonical(column, kind).cast("binary")), 1, 8), 16, 10).cast("long")


def column_hashes(df: DataFrame) -> DataFrame:
    """(column, rows, hash) of each column; no rows if ``df`` has none.  One aggregate."""
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(_hash(f.name, f.dataType)).alias(f"h{i}") for i, f in enumerate(df.schema.fields)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("rows"), F.col(f"h{i}").alias("hash"))
                     for i, c in enumerate(df.columns)])
    return sums.where("n > 0").select(F.inline(each))
