"""Bitmaps of keys, built in Spark: which keys of a scan may have partners elsewhere."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for a key, bits of a bitmap at most, bits of one piece of it. With more keys than MOST_BITS / BITS_PER_KEY, more of the
#: other keys pass by error, which costs work and changes no result.
BITS_PER_KEY = 32
MOST_BITS = 1 << 28
_PIECE = 1 << 15


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bytes in which the bits of ``keys`` (column key, well mixed 64-bit numbers) are set; their number is a power of two."""
    wanted, bits = BITS_PER_KEY * max(1, keys.count()), _PIECE
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    at = keys.select(F.shiftrightunsigned("key", 8).bitwiseAND(bits - 1).alias("at"))
    pieces = at.groupBy(F.expr(f"at div {_PIECE}").alias("piece")).agg(F.bitmap_construct_agg(F.col("at") % _PIECE).alias("set"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in pieces.toLocalIterator():  # at most MOST_BITS / 8 bytes
        out[row["piece"] * (_PIECE // 8):(row["piece"] + 1) * (_PIECE // 8)] = np.frombuffer(row["set"], dtype=np.uint8)
    return out


def is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys.astype(np.int64).view(np.uint64) >> np.uint64(8)) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
