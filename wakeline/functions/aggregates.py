"""Aggregates whose result does not depend on the order in which partial results meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_avg(x: str, digits: int = 4) -> Column:
    """Average of a measurement with up to ``digits`` decimals.

    The sum runs over whole units of the last decimal, so it is exact and a retried or differently merged
    task cannot change the result. Overflow raises an error instead of wrapping. Four decimals hold every
    field of a report; averages of derived values take six.
    """
    scale = f"{10 ** digits}D"
    units = f"sum(CAST(rint(({x}) * {scale}) AS BIGINT))"
    return F.expr(f"try_divide(CAST({units} AS DOUBLE), count({x}) * {scale})")


def steady_sum(x: str, digits: int = 4) -> Column:
    scale = f"{10 ** digits}D"
    return F.expr(f"CAST(sum(CAST(rint(({x}) * {scale}) AS BIGINT)) AS DOUBLE) / {scale}")
