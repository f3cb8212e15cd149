"""Deterministic uniforms keyed by (seed, draw site, row id).

``F.rand(seed)`` depends on the partitioning and gives equal columns for equal
seeds, so a regenerated table would differ from the first run and every draw
site would need its own seed.  A hash of ``seed|site|id`` is a pure function of
the row: the same table comes back under any partitioning, after any task
retry, and an SQL engine with ``md5`` can recompute every value exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import num, text

# 13 hex digits = 52 bits, the mantissa width of a double: the quotient is
# exact and lies in [0, 1).
_HEX_DIGITS = 13
_SCALE = float(2 ** 52)


def uniform(seed: int | str, site: str, id_col: Column | str) -> Column:
    """A uniform draw in [0, 1) for ``site`` on the row identified by ``id_col``."""
    if isinstance(id_col, str):
        id_col = F.col(id_col)
    # the key text is "seed|site|id"; a literal prefix + concat builds it at
    # half the cost of concat_ws (same bytes, so the same draws)
    key = F.concat(F.lit(f"{seed}|{site}|"), id_col.cast("string"))
    bits = F.conv(F.substring(F.md5(key), 1, _HEX_DIGITS), 16, 10).cast("bigint")
    return bits / F.lit(_SCALE)


def uniform_sql(seed: int | str, site: str, id_sql: str = "row_id") -> str:
    """``uniform`` as Spark SQL text, for projections built in one parse."""
    key = f"concat({text(f'{seed}|{site}|')}, CAST({id_sql} AS STRING))"
    return (f"(CAST(conv(substring(md5({key}), 1, {_HEX_DIGITS}), 16, 10) AS BIGINT) "
            f"/ {num(_SCALE)})")


def cascade_sql(seed, name: str, id_sql: str, labels: Sequence[str],
                thresholds: Sequence[float]) -> str:
    """A searched CASE where every branch makes a fresh draw, as Spark SQL text.

    Branch k compares its own uniform (site ``{name}_{k}``) with
    ``thresholds[k-1]``; the first success picks ``labels[k-1]``, and the last
    label is the fallback.  So the k-th label has probability
    ``t_k * prod_{j<k} (1 - t_j)``, not the width of a band.
    """
    if len(labels) != len(thresholds) + 1:
        raise ValueError("need exactly one more label than thresholds")
    whens = " ".join(
        f"WHEN {uniform_sql(seed, f'{name}_{k}', id_sql)} < {num(t)} "
        f"THEN {text(lab)}"
        for k, (lab, t) in enumerate(zip(labels, thresholds), start=1))
    return f"CASE {whens} ELSE {text(labels[-1])} END"


def split_flag(seed, id_col, eval_fraction: float, site: str = "split") -> Column:
    """True for rows of the evaluation part of a random split."""
    return uniform(seed, site, id_col) < F.lit(float(eval_fraction))
