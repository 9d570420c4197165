"""Feature cleaning and standard scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as finite doubles; null and infinite become 0. Absent features are added as 0."""
    have = set(df.columns)
    return df.withColumns({
        f: F.expr(f"CASE WHEN abs(CAST({f} AS DOUBLE)) < CAST('Infinity' AS DOUBLE) THEN CAST({f} AS DOUBLE) ELSE 0D END")
        if f in have else F.lit(0.0)
        for f in features
    })


def fit(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each feature: one aggregate row, whatever the size of the data."""
    figures = [F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")).alias(f) for f in features]
    row = filled(df, features).agg(*figures).first()
    return {f: (row[f]["mean"] or 0.0, row[f]["std"] or 0.0) for f in features}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / deviation; a constant feature is only centred."""
    return filled(df, list(fitted)).withColumns({
        f"{f}{suffix}": (F.col(f) - F.lit(mean)) / F.lit(std or 1.0) for f, (mean, std) in fitted.items()
    })
