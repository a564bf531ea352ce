"""Equal-count tiles (NTILE, quantile cut) by exact distributed selection, without a sort.

Tiles need no ranks, only the keys at k - 1 positions of the order by (value, id).  These are
found by rounds of counted ranges: the range of the first digit of the key is cut into BUCKETS
equal parts, one aggregate counts the rows in each, and the part that a position falls into is
the next round's range; all positions go together.  Once a digit is fixed the rows that share
it go on with the next one, unless the position ends with all of them.  A round returns at most
BUCKETS rows a position, so nothing grows with the data but the scan, and a row's tile is
then an expression: how many boundary keys it lies above.

Digits of the key are longs: the value, then the id (a whole number in two halves, or a string
as groups of seven of its bytes, in byte order, and its length at last).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, scratch_path

BUCKETS = 4096
_BYTES = 7
_NULL = (1 << 62) - 1  # nulls come last


def ntile_positions(n: int, k: int) -> list[int]:
    """Positions (1-based) at which the tiles 1 .. k-1 of NTILE(k) over n rows end."""
    return [t * (n // k) + min(t, n % k) for t in range(1, k)]


def qcut_positions(n: int, k: int) -> list[int]:
    """The same for a quantile cut of ranks 1 .. n with linearly interpolated, closed upper edges."""
    return [t * (n - 1) // k + 1 for t in range(1, k)]


def _id_digits(df: DataFrame, id_col: str) -> list[Column]:
    c = F.col(id_col)
    if not isinstance(df.schema[id_col].dataType, T.StringType):
        c = c.cast("long")  # in halves, so that differences don't overflow
        return [F.coalesce(F.shiftright(c, 32), F.lit(_NULL)), F.coalesce(c.bitwiseAND(0xFFFFFFFF), F.lit(_NULL))]
    longest = df.agg(F.max(F.octet_length(id_col)).alias("n")).first()["n"] or 0
    raw = c.cast("binary")
    parts = [F.conv(F.rpad(F.hex(F.substring(raw, 1 + at, _BYTES)), 2 * _BYTES, "0"), 16, 10).cast("long")
             for at in range(0, longest, _BYTES)]
    return [F.coalesce(p, F.lit(_NULL)) for p in [*parts, F.octet_length(c).cast("long")]]


class _Position:
    """The search for the key at one position: digits fixed so far, the range of the next one,
    and how many rows of that range the position still counts."""

    def __init__(self, rank: int, lows: list[int], highs: list[int]):
        self.rank, self.lows, self.highs, self.fixed, self.done = rank, lows, highs, [], False
        self.low, self.high = lows[0], highs[0]
        self.settle()

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // BUCKETS)

    def bucket(self, digits: list[str]) -> Column:
        here = F.col(digits[len(self.fixed)])
        inside = here.between(self.low, self.high)
        for name, value in zip(digits, self.fixed):
            inside &= F.col(name) == value
        return F.when(inside, F.floor((here - self.low) / self.width) if self.width > 1 else here - self.low)

    def narrow(self, counts: dict[int, int]) -> None:
        for bucket in sorted(counts):
            if self.rank <= counts[bucket]:
                break
            self.rank -= counts[bucket]
        low, width = self.low + bucket * self.width, self.width
        self.low, self.high = low, min(self.high, low + width - 1)
        if self.rank == counts[bucket]:
            self.fixed.append(self.high)
            self.done = True  # the position ends with all rows up to here
        else:
            self.settle()

    def settle(self) -> None:
        """Digits that can only have one value."""
        while not self.done and self.low == self.high:
            self.fixed.append(self.low)
            self.done = len(self.fixed) == len(self.lows)
            if not self.done:
                self.low, self.high = self.lows[len(self.fixed)], self.highs[len(self.fixed)]


def _select(keys: DataFrame, digits: list[str], ranks: list[int], ends: dict[str, tuple[int, int]]) -> list[list[int]]:
    """Leading digits of the keys at the 1-based ``ranks`` of the order by ``digits``."""
    lows, highs = [ends[d][0] for d in digits], [ends[d][1] for d in digits]
    positions = [_Position(r, lows, highs) for r in ranks]
    while open_ := [(j, p) for j, p in enumerate(positions) if not p.done]:
        hits = F.array_compact(F.array(*[F.when(p.bucket(digits).isNotNull(), F.struct(
            F.lit(j).alias("j"), p.bucket(digits).cast("long").alias("b"))) for j, p in open_]))
        counts: dict[int, dict[int, int]] = {j: {} for j, _ in open_}
        for row in keys.select(F.inline(hits)).groupBy("j", "b").count().collect():  # BUCKETS rows a position at most
            counts[row["j"]][row["b"]] = row["count"]
        for j, p in open_:
            p.narrow(counts[j])
    return [p.fixed for p in positions]


def _above(digits: list[Column], bound: list[int]) -> Column:
    """Whether a row's key lies above all keys that begin with ``bound``."""
    out = digits[len(bound) - 1] > bound[-1]
    for d, v in reversed(list(zip(digits[:-1], bound[:-1]))):
        out = (d > v) | ((d == v) & out)
    return out


def tile_columns(df: DataFrame, id_col: str, scores: dict[str, tuple[Column, Callable[[int], list[int]]]]) -> dict[str, Column]:
    """Tile columns (1 .. k) over ``df``: of each name the tile by (value, id), where a score is
    (value as a long, nulls last; positions of the tiles' ends for n rows).  (value, id) should
    be unique; rows with equal keys share a tile.

    The keys are written once for the rounds and removed afterwards; the columns are plain
    expressions with the boundaries as literals.
    """
    spark = df.sparkSession
    ids = _id_digits(df, id_col)
    values = {name: F.coalesce(value.cast("long"), F.lit(_NULL)) for name, (value, _) in scores.items()}
    id_names = [f"i{x}" for x in range(len(ids))]
    path = scratch_path(spark, f"tiles-{uuid.uuid4().hex}")
    df.select(*[v.alias(f"v_{n}") for n, v in values.items()], *[c.alias(i) for c, i in zip(ids, id_names)]).write.parquet(path)
    keys = spark.read.parquet(path)
    ends = keys.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in keys.columns for f in (F.min, F.max)]).first()
    out = {}
    for name, (_, positions) in scores.items():
        digits = [f"v_{name}", *id_names]
        limits = {d: (ends[f"min_{d}"], ends[f"max_{d}"]) for d in digits}
        ranks = [p for p in positions(ends["n"]) if 0 < p < ends["n"]] if ends["n"] else []
        # tiles that end at no row (fewer rows than tiles) come before none, so each row is counted above the rest
        bounds = _select(keys, digits, ranks, limits)
        columns = [values[name], *ids]
        tile = F.lit(1)
        for bound in bounds:
            tile = tile + _above(columns, bound).cast("int")
        out[name] = tile.cast("int")
    remove_path(spark, path)
    return out
