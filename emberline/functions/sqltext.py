"""Literal and identifier text for projections written as Spark SQL.

Wide projections (the generator, scoring) are emitted as SQL text and passed
to ``selectExpr``: one parse and one analysis instead of hundreds of
client-side column calls.  Doubles are written in exponent form with 17
significant digits, which Spark reads as DOUBLE and round-trips exactly.
"""

from __future__ import annotations


def num(x: float) -> str:
    """An exact DOUBLE literal."""
    return format(float(x), ".17e")


def text(x: str) -> str:
    """A string literal (backslash escapes, as Spark SQL reads them)."""
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A quoted column name."""
    return "`" + name.replace("`", "``") + "`"
