"""The warehouse copy: zone filter, column names, watermarked loads and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import labels
from wakeline.functions.aggregates import steady_avg
from wakeline.operators import merge
from wakeline.sources.files import since

CONTROL_COLUMNS = "table_name STRING, last_loaded TIMESTAMP_NTZ, rows_loaded BIGINT, updated_at TIMESTAMP_NTZ"


def in_coastal_zones(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows in any coastal zone; rows without a position stay."""
    zones = " OR ".join(labels.box_sql(lat, lon, z) for z in C.COASTAL_ZONES)
    return df.filter(f"{lat} IS NULL OR {lon} IS NULL OR {zones}")


def warehouse_names(df: DataFrame, upper: bool = True) -> DataFrame:
    """Grid columns under their warehouse names, upper case on request."""
    df = df.withColumnsRenamed({"lat_grid": "lat_bin", "lon_grid": "lon_bin"})
    return df.withColumnsRenamed({c: c.upper() for c in df.columns}) if upper else df


def incremental_load(
    stored: DataFrame, control: DataFrame, source: DataFrame, table: str, keys: tuple[str, ...], time: str,
    now: Column, zone: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(stored table, control table) after loading what is new or changed since the watermark.

    The watermark becomes the newest loaded time, not the clock, and its period is read again. Of several fresh rows
    with one key the newest counts. Rows are merged on their key and only those that differ from the stored ones
    count as loaded: loading the same source twice changes nothing.

    What is fresh lies at or after the watermark, so only the stored rows of that period are compared with it. Where
    ``time`` is part of the key they are also the only ones that can be replaced: all older rows pass by unshuffled, and the
    watermark reaches the scan as a literal, to prune files and partitions. Else older rows of the fresh keys go.
    """
    fresh = since(source, time, control, table)
    if zone:
        fresh = in_coastal_zones(fresh, *zone)
    newest = control.filter(F.col("table_name") == table).agg(F.max("last_loaded")).first()[0]
    fresh = merge.last_per_key(fresh.select(*stored.columns), keys, (time,))
    if newest is None:
        older, period = stored.limit(0), stored
    else:
        at_mark = F.lit(newest).cast("timestamp_ntz").cast(stored.schema[time].dataType)
        older, period = stored.filter(F.col(time).isNull() | (F.col(time) < at_mark)), stored.filter(F.col(time) >= at_mark)
    fresh = fresh.subtract(period)
    if time not in keys:
        older = older.join(fresh.select(*keys), list(keys), "left_anti").select(*stored.columns)
    loaded = older.unionByName(merge.upsert(period, fresh, keys))
    mark = fresh.agg(
        F.lit(table).alias("table_name"),
        F.max(F.col(time).cast("timestamp_ntz")).alias("last_loaded"),
        F.count("*").alias("rows_loaded"),
        F.first(now).cast("timestamp_ntz").alias("updated_at"),
    ).filter("rows_loaded > 0")
    tables = merge.upsert(
        control, mark, ("table_name",), on_match={"rows_loaded": F.expr("old.rows_loaded + fresh.rows_loaded")}
    )
    return loaded, tables


def fleet_by_region(latest: DataFrame) -> DataFrame:
    """View: the fleet by coastal region."""
    return (
        latest.groupBy(labels.region("lat", "lon").alias("us_region"))
        .agg(
            F.countDistinct("mmsi").alias("total_vessels"),
            F.countDistinct(F.expr("if(risk_level = 'HIGH', mmsi, NULL)")).alias("high_risk_vessels"),
            F.countDistinct(F.expr("if(is_anomaly, mmsi, NULL)")).alias("anomalous_vessels"),
            F.round(steady_avg("sog"), 2).alias("avg_speed_kn"),
            F.max("updated_at").alias("data_freshness"),
        )
        .orderBy(F.desc("total_vessels"), "us_region")
    )


def weekly_trend(daily: DataFrame) -> DataFrame:
    """View: daily statistics rolled up by week (Monday). Needs ``collision_alerts``."""
    return (
        daily.groupBy(F.expr("CAST(date_trunc('week', stat_date) AS TIMESTAMP_NTZ)").alias("week_start"))
        .agg(
            F.sum("total_vessels").alias("total_vessels"),
            F.sum("anomaly_count").alias("total_anomalies"),
            F.sum("high_risk_count").alias("total_high_risk"),
            F.sum("collision_alerts").alias("total_collisions"),
            F.round(steady_avg("avg_sog", 6), 2).alias("avg_fleet_speed"),
        )
        .orderBy(F.desc("week_start"))
    )
