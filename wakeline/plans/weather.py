"""Weather: payload parsing, hourly severity table, and its join to density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import WEATHER_CELL_DEG
from wakeline.functions import cells, cleaning, labels
from wakeline.functions.aggregates import steady_avg

PAYLOAD = "struct<hourly:struct<time:array<string>,wind_speed_10m:array<string>,wave_height:array<string>>>"


def cell_of(lat: str = "lat", lon: str = "lon") -> dict[str, Column]:
    """Half-degree weather cell of a position, as whole numbers."""
    return {
        "lat_cell": cells.index(lat, WEATHER_CELL_DEG, "floor"),
        "lon_cell": cells.index(lon, WEATHER_CELL_DEG, "floor"),
    }


def occupied_cells(rows: DataFrame) -> DataFrame:
    """The distinct weather cells with any report."""
    known = rows.dropna(subset=["lat", "lon", "base_datetime"])
    spots = known.select(*[c.alias(n) for n, c in cell_of().items()]).distinct()
    return spots.select(
        cells.degrees("lat_cell", WEATHER_CELL_DEG, 1).alias("lat_bin"),
        cells.degrees("lon_cell", WEATHER_CELL_DEG, 1).alias("lon_bin"),
    )


def date_span(rows: DataFrame) -> DataFrame:
    known = rows.dropna(subset=["lat", "lon", "base_datetime"])
    return known.agg(
        F.to_date(F.min("base_datetime")).alias("first_day"), F.to_date(F.max("base_datetime")).alias("last_day")
    )


def parse_payload(raw: DataFrame, column: str = "payload") -> DataFrame:
    """One row per hour from a payload of parallel arrays; values that are no numbers become null."""
    hourly = F.from_json(F.col(column), PAYLOAD)["hourly"]
    rows = raw.withColumn("__h", hourly).withColumn(
        "__hour",
        F.explode(F.arrays_zip(
            F.col("__h.time").alias("time"), F.col("__h.wind_speed_10m").alias("wind"),
            F.col("__h.wave_height").alias("wave"),
        )),
    )
    return rows.select(
        *[c for c in raw.columns if c != column],
        F.coalesce(
            F.col("__hour.time").try_cast("timestamp_ntz"), cleaning.iso_time("__hour.time")
        ).alias("time"),
        F.col("__hour.wind").try_cast("double").alias("wind_speed_10m"),
        F.col("__hour.wave").try_cast("double").alias("wave_height"),
    ).filter(F.col("time").isNotNull())


def hourly_weather(readings: DataFrame) -> DataFrame:
    """Mean wind and wave per weather cell and hour."""
    return readings.groupBy(
        "lat_cell", "lon_cell", cleaning.truncate_time("hour", "time").alias("hour_bucket")
    ).agg(
        steady_avg("wind_speed_10m").alias("wind_speed_10m"),
        steady_avg("wave_height").alias("wave_height"),
    )


def dim_weather(readings: DataFrame) -> DataFrame:
    """The weather dimension: hourly means with severity (six decimals)."""
    return hourly_weather(readings).select(
        "lat_cell", "lon_cell",
        cells.degrees("lat_cell", WEATHER_CELL_DEG, 1).alias("lat_bin"),
        cells.degrees("lon_cell", WEATHER_CELL_DEG, 1).alias("lon_bin"),
        "hour_bucket", "wind_speed_10m", "wave_height",
        F.round(labels.weather_severity("wind_speed_10m", "wave_height"), 6).alias("weather_severity"),
    )


def with_weather(density: DataFrame, weather: DataFrame) -> DataFrame:
    """Density rows with the severity of their weather cell and hour, null when there is none.

    Joined on whole-number cells. The weather table has at most one row per half-degree cell and hour;
    whether it is small enough to broadcast is left to the size Spark measures.
    """
    keyed = density.withColumns(cell_of("lat_bin", "lon_bin"))
    side = weather.select("lat_cell", "lon_cell", "hour_bucket", "weather_severity")
    return keyed.join(side, ["lat_cell", "lon_cell", "hour_bucket"], "left").drop("lat_cell", "lon_cell")


def with_weather_exact(density: DataFrame, weather: DataFrame) -> DataFrame:
    """The form that matches the cell coordinates themselves, rounded to one decimal (as whole tenths)."""
    tenth = lambda c: F.round(F.col(c) * 10).cast("bigint")
    keyed = density.withColumns({"__y": tenth("lat_bin"), "__x": tenth("lon_bin")})
    side = weather.select(
        tenth("lat_bin").alias("__y"), tenth("lon_bin").alias("__x"), "hour_bucket", "weather_severity"
    )
    return keyed.join(side, ["__y", "__x", "hour_bucket"], "left").drop("__y", "__x")


def coverage(joined: DataFrame) -> DataFrame:
    """How many density rows found weather, how many with severity above zero."""
    matched = F.count("weather_severity")
    total = F.count("*")
    return joined.agg(
        matched.alias("matched"),
        total.alias("total"),
        F.round(F.try_divide(matched * F.lit(100.0), F.greatest(total, F.lit(1))), 1).alias("matched_pct"),
        F.count_if(F.col("weather_severity") > 0).alias("nonzero"),
    )


def severity_profile(weather: DataFrame) -> DataFrame:
    s = F.col("weather_severity")
    return weather.agg(
        F.min(s).alias("sev_min"), F.round(steady_avg("weather_severity"), 4).alias("sev_mean"), F.max(s).alias("sev_max")
    )
