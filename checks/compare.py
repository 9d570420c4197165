"""Runs a registered query on Spark and its counterpart on DuckDB and compares every value."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(0.0 if value == 0 else value)
    return repr(value)


def _rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_cell(v) for v in row) for row in zip(*columns)) if columns else Counter()


def _type(t) -> str:
    text = str(t).replace("large_", "")
    return "string" if text == "string_view" else text


def difference(spark: SparkSession, query, oracle: str, sf_dir: str, con=None, allow_empty: bool = False) -> str | None:
    """None when names, types, row count and all values agree, else a description."""
    con = con or connection(sf_dir)
    ours = query(spark, sf_dir).toArrow()
    theirs = con.execute(oracle).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} vs {sorted(theirs.column_names)}"
    types = {
        n: (_type(ours.schema.field(n).type), _type(theirs.schema.field(n).type))
        for n in ours.column_names
    }
    wrong = {n: t for n, t in types.items() if t[0] != t[1]}
    if wrong:
        return f"types {wrong}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} vs {theirs.num_rows}"
    if ours.num_rows == 0 and not allow_empty:
        return "no rows"
    a, b = _rows(ours), _rows(theirs)
    if a != b:
        names = sorted(ours.column_names)
        return f"values {names}: only Spark {list((a - b).items())[:3]}, only DuckDB {list((b - a).items())[:3]}"
    return None
