"""The registered queries against DuckDB on the smallest data folder."""

import pytest

import __spark_entry__ as contract
from checks.compare import connection, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
#: Queries that rightly find nothing in the smallest folder; all others must return rows.
EMPTY_HERE = {"prj_19_snapshot", "prj_23_congestion_zones", "snk_16_rewrite_clustered"}


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, con, name):
    assert difference(spark, QUERIES[name], ORACLES[name], SF, con, allow_empty=name in EMPTY_HERE) is None


def test_watermark_itself_is_not_newer(spark):
    """At the smallest size no row lies on the watermark; here one does."""
    from pyspark.sql import functions as F

    from wakeline.sources import files

    rows = spark.range(3).select(F.expr("TIMESTAMP_NTZ '2024-01-15 11:00:00' + id * INTERVAL 1 HOUR").alias("at"))
    control = spark.sql("SELECT 'd' AS table_name, TIMESTAMP_NTZ '2024-01-15 12:00:00' AS last_loaded")
    assert files.newer_than(rows, "at", control, "d").count() == 1
    assert files.since(rows, "at", control, "d").count() == 2
    assert files.newer_than(rows, "at", control, "other").count() == 3
