"""Column-level building blocks (built-in Spark expressions, no UDFs)."""

from .rng import cascade_sql, split_flag, uniform, uniform_sql
from .scores import (humidity_risk_score, rule_label, temp_risk_score,
                     threshold_score, wildfire_rule_label)
from .sqltext import ident, num, text
from .temporal import iso_datetime, iso_instant, month_of, zoned_wall_time

__all__ = [
    "cascade_sql", "split_flag", "uniform", "uniform_sql",
    "humidity_risk_score", "rule_label", "temp_risk_score", "threshold_score",
    "wildfire_rule_label", "ident", "num", "text", "iso_datetime", "iso_instant", "month_of",
    "zoned_wall_time",
]
