"""Position reports derived from the ``events`` table: whole-number arithmetic, so that every engine agrees.

Vessels 2k and 2k+1 travel as a pair, every tenth sits in the Houston box, one report in fifty is sent twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import cleaning
from wakeline.plans import weather as weather_plan

_TEMPLATE = """
WITH b AS (
  SELECT event_id AS e, user_id AS u, {idiv} AS g, CAST({k} AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         {ts} AS base_datetime, CAST({day} AS BIGINT) AS d
  FROM {events}),
p AS (
  SELECT *,
    CASE WHEN e % 301 = 0 THEN 0
         WHEN u % 10 = 0 THEN 296000 + (e % 7) * 2
         ELSE 240000 + (g * 7919 + (d % 30) * (500 + g % 1500)) % 230000 + (e % 7) * 2
              + CASE WHEN e % 211 = 0 THEN 180000 ELSE 0 END END AS lat_e4,
    CASE WHEN e % 301 = 0 THEN 0
         WHEN u % 10 = 0 THEN -950000 + (e % 5) * 2
         ELSE -1250000 + (g * 104729 + (d % 30) * (500 + g % 170)) % 590000 + (e % 5) * 2 END AS lon_e4
  FROM b),
r AS (
  SELECT e AS event_id,
    concat('36', lpad(CAST(u AS VARCHAR{n}), 7, '0')) AS mmsi, base_datetime,
    CAST(lat_e4 AS DOUBLE) / 10000 AS lat, CAST(lon_e4 AS DOUBLE) / 10000 AS lon,
    CASE WHEN e % 97 = 0 THEN CAST(1023 AS DOUBLE) / 10
         WHEN e % 10 = 0 THEN CAST(2 AS DOUBLE) / 10
         ELSE CAST(cents % 320 AS DOUBLE) / 10 END AS sog,
    CAST((k * 37 + e) % 360 AS DOUBLE) AS cog,
    CASE WHEN e % 89 = 0 THEN CAST(511 AS DOUBLE) ELSE CAST((k * 36 + u) % 360 AS DOUBLE) END AS heading,
    CASE WHEN e % 5 = 0 THEN NULL ELSE concat('VESSEL-', CAST(u AS VARCHAR{n})) END AS vessel_name,
    CASE WHEN e % 4 = 0 THEN NULL ELSE concat('IMO', CAST(9000000 + u AS VARCHAR{n})) END AS imo,
    CASE WHEN e % 6 = 0 THEN NULL ELSE concat('CS', CAST(u AS VARCHAR{n})) END AS call_sign,
    CASE u % 8 WHEN 0 THEN '30' WHEN 1 THEN '31' WHEN 2 THEN '36' WHEN 3 THEN '52'
               WHEN 4 THEN '60' WHEN 5 THEN '70' WHEN 6 THEN '80' ELSE '99' END AS vessel_type,
    CASE e % 4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '5' ELSE '4' END AS status,
    CASE WHEN e % 3 = 0 THEN NULL ELSE CAST(50 + u % 250 AS DOUBLE) END AS length,
    CASE WHEN e % 7 = 0 THEN NULL ELSE CAST(8 + u % 40 AS DOUBLE) END AS width,
    CASE WHEN e % 11 = 0 THEN NULL ELSE CAST(20 + u % 100 AS DOUBLE) / 10 END AS draft,
    CASE WHEN e % 9 = 0 THEN NULL ELSE CAST(u % 90 AS VARCHAR{n}) END AS cargo,
    CASE WHEN u % 3 = 0 THEN 'B' ELSE 'A' END AS transceiver_class
  FROM p)
SELECT * FROM r UNION ALL SELECT * FROM r WHERE event_id % 50 = 0
"""


def duckdb_sql() -> str:
    return _TEMPLATE.format(
        idiv="user_id // 2", k="json_extract(props,'$.k')", ts="date_trunc('second', ts)",
        day="date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))", n="", events="events",
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived position reports of one data folder."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(
        _TEMPLATE.format(
            idiv="user_id div 2", k="get_json_object(props,'$.k')",
            ts="CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ)",
            day="datediff(CAST(ts AS DATE), DATE '1970-01-01')", n="(20)", events="{events}",
        ),
        events=events,
    )


def weather(rows: DataFrame) -> DataFrame:
    """Weather readings derived from the occupied cell-hours of ``rows`` (one cell-hour in five has none)."""
    hours = rows.select(
        *[c.alias(n) for n, c in weather_plan.cell_of().items()],
        cleaning.truncate_time("hour", "base_datetime").alias("time"),
    ).distinct()
    y, x, h = F.abs("lat_cell"), F.abs("lon_cell"), F.hour("time")
    return hours.filter((y + x + h) % 5 != 0).select(
        "lat_cell", "lon_cell", "time",
        (((y * 131 + x) * 7 + h) % 300 / F.lit(10.0)).alias("wind_speed_10m"),
        F.when((y + x) % 3 != 0, (y + h) % 70 / F.lit(10.0)).alias("wave_height"),
    )
