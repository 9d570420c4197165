"""Column names, sizes and stored intermediate tables shared by the text operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def free_name(base: str, *taken: str) -> str:
    """``base``, or with underscores in front of it where ``taken`` has that name in any case."""
    used = {name.lower() for name in taken}
    while base.lower() in used:
        base = "_" + base
    return base


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever else the table has."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands Python at most about 8 MB at once; rows alone do not bound long texts."""
    conf = df.sparkSession.conf
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
    now = conf.get(name, None)
    if now is None or not now.isdigit() or int(now) > most:
        conf.set(name, str(most))
    return df


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Size of all texts: one scan of one column, one number."""
    return df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def parts_of(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))
