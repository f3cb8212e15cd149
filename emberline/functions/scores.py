"""Scalar column builders for risk scores and rule labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference_values as RV

_OPS = {
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def threshold_score(col, op: str, cuts: Sequence[tuple[float, int]], default: int) -> Column:
    """First cut whose comparison holds gives its score; else ``default``.

    A NULL input satisfies no comparison and falls through to the default,
    like the SQL CASE it mirrors.  The result is a bigint.
    """
    c = _col(col)
    cmp = _OPS[op]
    expr = None
    for cut, score in cuts:
        cond = cmp(c, F.lit(float(cut)))
        val = F.lit(int(score)).cast("bigint")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(int(default)).cast("bigint"))


def temp_risk_score(col="temperature_celsius") -> Column:
    return threshold_score(col, ">", RV.TEMP_SCORE_CUTS, RV.TEMP_SCORE_DEFAULT)


def humidity_risk_score(col="humidity_percent") -> Column:
    return threshold_score(col, "<", RV.HUMIDITY_SCORE_CUTS, RV.HUMIDITY_SCORE_DEFAULT)


def rule_label(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Searched CASE over (condition, label) pairs, first match wins."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def wildfire_rule_label(temperature="temperature_celsius", humidity="humidity_percent",
                        wind="wind_speed_ms") -> Column:
    t, h, w = _col(temperature), _col(humidity), _col(wind)
    hi, mo = RV.HIGH_RULE, RV.MODERATE_RULE
    return rule_label(
        [
            ((t > F.lit(hi["temperature_gt"])) & (h < F.lit(hi["humidity_lt"]))
             & (w > F.lit(hi["wind_gt"])), "high"),
            ((t > F.lit(mo["temperature_gt"])) & (h < F.lit(mo["humidity_lt"])), "moderate"),
        ],
        "low",
    )
