"""A Bloom filter of fixed size over a column of 64-bit hashes.

It is the one thing about a whole table that its users broadcast: ``BITS``
bits, however many rows there are.  A member is always found.  Others are found
the more often the fuller the filter is, so users check again what it lets
through; a full filter costs work, never a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB
PROBES = 4


def bit_filter(df: DataFrame, column: str) -> np.ndarray:
    """The filter of all values of a long column, as 64-bit words."""
    low = F.col(column).bitwiseAND(BITS - 1)
    step = F.shiftrightunsigned(column, 32).bitwiseAND(BITS - 1).bitwiseOR(1)
    places = df.select(F.explode(F.array(*[(low + step * i).bitwiseAND(BITS - 1) for i in range(PROBES)])).alias("p"))
    mask = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(mask).alias("bits"))
    out = np.zeros(BITS // 64, np.int64)
    found = words.select("w", "bits").toArrow()  # at most BITS / 64 rows
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def passes(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` the filter lets through."""
    v = values.astype(np.uint64, copy=False) if values.dtype != np.int64 else values.view(np.uint64)
    top = np.uint64(BITS - 1)
    low, step = v & top, ((v >> np.uint64(32)) & top) | np.uint64(1)
    ok = np.ones(len(v), bool)
    for i in range(PROBES):
        p = (low + step * np.uint64(i)) & top
        ok &= ((words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
    return ok
