"""Reproducible shuffle into shards by a keyed permutation of row numbers.

Every row gets its number in a total order; a Feistel network over two
residues (left modulo a, right modulo b, a*b just above n) permutes
0 .. a*b-1, and cycle walking - applying the permutation again while the value
is n or more - restricts it to 0 .. n-1.  The place p of a row gives its shard
(p mod shards) and its slot (p div shards), so both can be computed, and
undone, from the row number alone: no shuffle of the texts, no state.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.row_id import with_row_id

ROUNDS = 8


def mix64(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) of ``x`` under ``key``."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def round_keys(seed: int) -> list[int]:
    return [int(k) for k in mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64), seed & (2**64 - 1))]


def _halves(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _network(x: np.ndarray, n: int, keys: list[int], undo: bool) -> np.ndarray:
    a, b = (np.uint64(v) for v in _halves(n))
    left, right = x // b, x % b
    order = list(enumerate(keys))
    for i, key in reversed(order) if undo else order:
        if i % 2 == 0:
            f = mix64(right, key) % a
            left = (left + (a - f if undo else f)) % a
        else:
            f = mix64(left, key) % b
            right = (right + (b - f if undo else f)) % b
    return left * b + right


def permute(rows, n: int, seed: int, undo: bool = False) -> np.ndarray:
    """Where rows 0 .. n-1 go (``undo``: where places come from), a bijection on 0 .. n-1."""
    keys = round_keys(seed)
    out = np.asarray(rows, dtype=np.uint64)
    out = _network(out, n, keys, undo)
    while (out >= n).any():
        beyond = out >= n
        out[beyond] = _network(out[beyond], n, keys, undo)
    return out.astype(np.int64)


def assign_shards(df: DataFrame, order_by: list, n_shards: int, seed: int = 0) -> DataFrame:
    """``df`` plus ``row_number`` (0-based, by ``order_by``, ties by the other
    columns), ``shard`` and ``slot``.

    Shard sizes differ by one row at most, and the slots of a shard run from 0
    without gaps.  Only the columns of ``df`` move: pass a narrow frame and join
    texts by key where they are needed.  Same rows, seed and shard count give
    the same result on any cluster.  NULL keys sort first; rows equal in every
    column are interchangeable; an empty table gives an empty result.
    """
    @F.pandas_udf("long")
    def place(row: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), int(n.iloc[0]), seed) if len(row) else [], dtype="int64")

    numbered = with_row_id(df, order_by, name="row_number", total="_sh_n")
    return (numbered.withColumn("row_number", F.col("row_number") - 1)
            .withColumn("_sh_p", place("row_number", "_sh_n"))
            .withColumn("shard", (F.col("_sh_p") % n_shards).cast("int"))
            .withColumn("slot", F.expr(f"_sh_p div {n_shards}"))
            .drop("_sh_p", "_sh_n"))
