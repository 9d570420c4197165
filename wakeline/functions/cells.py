"""Grid cells.

Cells are computed as whole numbers (``*_index``); grouping and joining use the whole numbers, and the
degree value is derived once for output. Floating-point cells never serve as keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding to whole numbers is done by a shifted cast: ``round`` on doubles goes through decimal text, which
# costs more than all the rest of a cell computation.
_RULES = {
    "nearest": "CAST(({x}) / {w}D + if(({x}) < 0, -0.5D, 0.5D) AS BIGINT)",
    "truncated": "CAST(({x}) / {w}D AS BIGINT)",
    "floor": "CAST(floor(({x}) / {w}D) AS BIGINT)",
    "half_even": "CAST(rint(({x}) / {w}D) AS BIGINT)",
    "tenths": "CAST(rint(round({x}, 1) * 10D) AS BIGINT)",
}


def index(x: str, width: float = 0.1, rule: str = "nearest") -> Column:
    """Whole-number cell: ``nearest``, ``truncated`` (toward zero), ``floor``, ``half_even``, or
    ``tenths`` (the decimal form rounded to one place)."""
    return F.expr(_RULES[rule].format(x=x, w=width))


def degrees(cell: str, width: float = 0.1, digits: int = 2) -> Column:
    """The coordinate of a whole-number cell, as the double nearest to its decimal value."""
    per_degree = round(1 / width)
    if abs(per_degree * width - 1) < 1e-9:
        return F.expr(f"{cell} / {per_degree}D")
    return F.expr(f"round({cell} * {width}D, {digits})")


def coordinate(x: str, width: float = 0.1, rule: str = "nearest", digits: int = 2) -> Column:
    """The coordinate of the cell of ``x``."""
    return degrees(_RULES[rule].format(x=x, w=width), width, digits)


def fine(x: str) -> Column:
    """Position rounded to 0.01 degrees."""
    return F.expr(f"round({x}, 2)")
