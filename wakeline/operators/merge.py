"""Upserts on plain tables: a full outer join of the stored rows with the new ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; the merge needs one new row per key."""
    others = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("__row")
    return rows.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*rows.columns)


def upsert(
    stored: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    on_match: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Stored rows updated by ``new`` rows of the same key, plus the new keys.

    Columns in ``keep`` are written on insert only. ``on_match`` gives a column another value for matched
    rows; its expressions see the two sides as structs ``old`` and ``fresh``. Both sides need unique keys.
    """
    on_match = on_match or {}
    columns = stored.columns

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c) for c in columns]).alias(name))

    both = side(stored, "old").join(side(new, "fresh"), list(keys), "full_outer")
    old, fresh = F.col("old"), F.col("fresh")
    matched = old.isNotNull() & fresh.isNotNull()

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        updated = on_match.get(c, old[c] if c in keep else fresh[c])
        return F.when(matched, updated).when(fresh.isNotNull(), fresh[c]).otherwise(old[c]).alias(c)

    return both.select(*[pick(c) for c in columns])
