"""A bit table of fixed size as a pre-filter for joins.

Spark builds it (each task a part, merged in the cluster); its size is a parameter, not a
function of the data, so sending it to every task is safe at any scale.  It only thins the
probing side: what passes is joined exactly, so a full table costs time and never rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25  # 2^25 bits: 4 MB
_BUCKET = 15  # Spark's bitmap buckets hold 32768 bits


def build(keys: DataFrame, column: str, bits: int = BITS) -> bytes:
    """Bits set at the low ``bits`` bits of the long ``column`` (a hash; nulls are skipped)."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    parts = (keys.where(F.col(column).isNotNull())
             .select(F.shiftright(at, _BUCKET).cast("int").alias("bucket"),
                     at.bitwiseAND(F.lit((1 << _BUCKET) - 1)).alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    table = bytearray(1 << (bits - 3))
    for row in parts.toLocalIterator():  # 2^bits / 8 bytes at most, by the parameter
        at_byte = row["bucket"] << (_BUCKET - 3)
        table[at_byte: at_byte + len(row["bits"])] = row["bits"][: 1 << (_BUCKET - 3)]
    return bytes(table)


def test(table: bytes, hashes: np.ndarray) -> np.ndarray:
    """For unsigned 64-bit hashes: whether their bits are set."""
    bits = np.frombuffer(table, np.uint8)
    at = hashes & np.uint64(len(table) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
