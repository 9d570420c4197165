"""Traffic density per grid cell and hour, in the forms its consumers need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Thresholds
from wakeline.functions import cells, cleaning, labels
from wakeline.functions.aggregates import steady_avg

CELL = 0.1


def traffic_density(silver: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Pings, vessels, mean speed and stopped pings by nearest 0.1 degree cell, hour and split.

    Grouped on whole-number cells. The distinct count makes Spark aggregate per (group, vessel) first, so a
    crowded cell is already reduced to one row per vessel and map task when it travels.
    """
    hour = cleaning.truncate_time("hour", "base_datetime")
    return (
        silver.groupBy(
            cells.index("lat", CELL).alias("__lat"),
            cells.index("lon", CELL).alias("__lon"),
            hour.alias("hour_bucket"),
            "data_split",
        )
        .agg(
            F.count("*").alias("vessel_count"),
            F.countDistinct("mmsi").alias("unique_vessels"),
            steady_avg("sog").alias("avg_sog"),
            F.count_if(F.col("sog") < t.stopped_kn).alias("stopped_count"),
        )
        .select(
            cells.degrees("__lat", CELL, 1).alias("lat_bin"),
            cells.degrees("__lon", CELL, 1).alias("lon_bin"),
            "hour_bucket", "data_split", "vessel_count", "unique_vessels", "avg_sog", "stopped_count",
            labels.congestion_level("vessel_count", t.congestion_high, t.congestion_medium)
            .alias("congestion_level"),
        )
    )


def traffic_density_truncated(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The form with cells cut toward zero and no split; ``is_stopped`` must be present."""
    hour = cleaning.truncate_time("hour", "base_datetime")
    return (
        rows.groupBy(
            cells.index("lat", CELL, "truncated").alias("__lat"),
            cells.index("lon", CELL, "truncated").alias("__lon"),
            hour.alias("hour_bucket"),
        )
        .agg(
            F.count("mmsi").alias("vessel_count"),
            F.countDistinct("mmsi").alias("unique_vessels"),
            steady_avg("sog").alias("avg_sog"),
            F.sum(F.col("is_stopped").cast("int")).alias("stopped_count"),
        )
        .select(
            cells.degrees("__lat", CELL).alias("lat_grid"),
            cells.degrees("__lon", CELL).alias("lon_grid"),
            "hour_bucket", "vessel_count", "unique_vessels", "avg_sog", "stopped_count",
            labels.congestion_level("vessel_count", t.congestion_high, t.congestion_medium)
            .alias("congestion_level"),
        )
    )


def training_density(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The training form: distinct vessels per truncated cell-hour, with calendar features."""
    hour = cleaning.truncate_time("hour", "base_datetime")
    cellhours = (
        rows.groupBy(
            cells.index("lat", CELL, "truncated").alias("lat_cell"),
            cells.index("lon", CELL, "truncated").alias("lon_cell"),
            hour.alias("hour_bucket"),
        )
        .agg(
            F.countDistinct("mmsi").alias("vessel_count"),
            steady_avg("sog").alias("avg_sog"),
            F.count_if(F.col("sog") < t.stopped_kn).alias("stopped_count"),
        )
    )
    weekday = F.weekday("hour_bucket")
    return cellhours.select(
        "lat_cell", "lon_cell",
        cells.degrees("lat_cell", CELL).alias("lat_bin"),
        cells.degrees("lon_cell", CELL).alias("lon_bin"),
        "hour_bucket", "vessel_count", "avg_sog", "stopped_count",
        F.hour("hour_bucket").alias("hour"),
        weekday.alias("day_of_week"),
        (weekday >= 5).cast("int").alias("is_weekend"),
        labels.congestion_level("vessel_count", t.congestion_high, t.congestion_medium)
        .alias("congestion_level"),
    )


def raw_track_density(track: DataFrame, top: int | None = None) -> DataFrame:
    """Fallback heat map straight from track rows: other thresholds, weight relative to the busiest cell."""
    counted = (
        track.groupBy(
            cells.index("lat", CELL, "tenths").alias("__lat"),
            cells.index("lon", CELL, "tenths").alias("__lon"),
        )
        .agg(F.count("*").alias("vessel_count"), steady_avg("sog").alias("avg_sog"))
    )
    best = counted if top is None else counted.orderBy(F.desc("vessel_count"), "__lat", "__lon").limit(top)
    return heat_weight(best).select(
        cells.degrees("__lat", CELL, 1).alias("lat"),
        cells.degrees("__lon", CELL, 1).alias("lon"),
        "vessel_count",
        F.coalesce("avg_sog", F.lit(0.0)).alias("avg_sog"),
        labels.congestion_level("vessel_count", 10_000, 1_000).alias("congestion_level"),
        "weight",
    )


def live_heat(rows: DataFrame) -> DataFrame:
    """Half-degree heat map of the live table: distinct vessels, levels at 10 and 5."""
    return (
        rows.groupBy(
            cells.index("lat", 0.5, "truncated").alias("__lat"),
            cells.index("lon", 0.5, "truncated").alias("__lon"),
        )
        .agg(F.countDistinct("mmsi").alias("vessel_count"), steady_avg("sog").alias("avg_sog"))
        .select(
            cells.degrees("__lat", 0.5, 1).alias("lat"),
            cells.degrees("__lon", 0.5, 1).alias("lon"),
            "vessel_count", "avg_sog",
            labels.congestion_level("vessel_count", 10, 5).alias("congestion_level"),
        )
    )


def heat_weight(df: DataFrame, count: str = "vessel_count") -> DataFrame:
    """Share of the largest count, at most 1. The maximum is one number, read by a scalar subquery."""
    top = df.agg(F.max(count)).scalar()
    return df.withColumn("weight", F.least(F.col(count) / top, F.lit(1.0)))


def peak_hours(density: DataFrame, min_vessels: int = 1) -> DataFrame:
    """The busiest hour of every cell; ties go to the earliest hour, then to the first split by name."""
    ranked = density.filter(F.col("vessel_count") >= min_vessels).select(
        cells.index("lat_bin", CELL, "tenths").alias("__lat"),
        cells.index("lon_bin", CELL, "tenths").alias("__lon"),
        F.struct("vessel_count", "avg_sog", "congestion_level", "hour_bucket", "data_split").alias("__row"),
        F.struct(
            -F.col("vessel_count"), F.col("hour_bucket"), F.col("data_split")
        ).alias("__rank"),
    )
    return (
        ranked.groupBy("__lat", "__lon")
        .agg(F.min_by("__row", "__rank").alias("__row"))
        .select(
            cells.degrees("__lat", CELL, 1).alias("lat_bin"),
            cells.degrees("__lon", CELL, 1).alias("lon_bin"),
            "__row.vessel_count", "__row.avg_sog", "__row.congestion_level",
        )
    )
