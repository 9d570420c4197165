"""Aggregate reports over the served tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import cells, cleaning, labels
from wakeline.functions.aggregates import steady_avg, steady_sum
from wakeline.plans.queries import days_before


def _in_waters(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.filter(labels.in_us_waters(lat, lon))


def fleet_kpis(latest: DataFrame, with_diversity: bool = True) -> DataFrame:
    """One row of fleet figures in US waters.

    All counts are over one row per vessel and conditional, so no separate distinct passes are planned.
    """
    rows = _in_waters(latest, "lat", "lon")
    where = lambda condition: F.expr(f"count_if({condition})")
    figures = {
        "total_vessels": F.count("*"),
        "high_risk_vessels": where("risk_level = 'HIGH'"),
        "anomalous_vessels": where("is_anomaly"),
        "fleet_avg_speed_kn": F.round(steady_avg("sog"), 2),
        "east_coast_vessels": where("lon BETWEEN -82 AND -66"),
        "west_coast_vessels": where("lon BETWEEN -125 AND -117"),
        "gulf_vessels": where("lon BETWEEN -97 AND -80 AND lat BETWEEN 24 AND 31"),
        "data_freshness": F.max("updated_at"),
    }
    if with_diversity:
        figures["vessel_type_diversity"] = F.countDistinct("vessel_type")
    return rows.agg(*[value.alias(name) for name, value in figures.items()])


def busiest_lanes(
    density: DataFrame, top_n: int = 50, with_days: bool = True, lexical: bool = False,
) -> DataFrame:
    """The busiest 0.1 degree cells in US waters. ``lexical`` compares levels by spelling, not by meaning."""
    rows = _in_waters(density, "lat_bin", "lon_bin")
    peak = F.max("congestion_level") if lexical else F.max_by("congestion_level", labels.ordinal("congestion_level", C.LEVEL_ORDER))
    figures = [
        F.sum("vessel_count").alias("total_vessels"),
        F.sum("unique_vessels").alias("unique_vessels"),
        F.round(steady_avg("avg_sog", 6), 2).alias("avg_speed_kn"),
        peak.alias("peak_congestion"),
    ]
    if with_days:
        figures.append(F.countDistinct(F.to_date("hour_bucket")).alias("active_days"))
    return (
        rows.groupBy(
            cells.index("lat_bin", 0.1, "tenths").alias("__lat"),
            cells.index("lon_bin", 0.1, "tenths").alias("__lon"),
            labels.region("lat_bin", "lon_bin").alias("us_region"),
        )
        .agg(*figures)
        .orderBy(F.desc("total_vessels"), "__lat", "__lon")
        .limit(top_n)
        .withColumns({"lat_grid": cells.degrees("__lat", 0.1, 1), "lon_grid": cells.degrees("__lon", 0.1, 1)})
        .drop("__lat", "__lon")
    )


def anomaly_trends(scored: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Anomalies per day, kind and region."""
    since = days_before(as_of.cast("date").cast("timestamp_ntz"), days)
    rows = _in_waters(scored.filter("is_anomaly"), "lat", "lon").filter(F.col("base_datetime") >= since)
    return (
        rows.groupBy(
            cleaning.truncate_time("day", "base_datetime").alias("event_date"), "anomaly_type",
            labels.region("lat", "lon").alias("us_region"),
        )
        .agg(
            F.count("*").alias("anomaly_count"),
            F.round(steady_avg("anomaly_score", 6), 4).alias("avg_score"),
            F.countDistinct("mmsi").alias("unique_vessels"),
        )
        .orderBy(F.desc("event_date"), F.desc("anomaly_count"), "anomaly_type", "us_region")
    )


def congestion_by_hour(
    density: DataFrame, as_of: Column | None = None, days: int = 14, with_lakes: bool = True,
    with_stopped: bool = True,
) -> DataFrame:
    """Cells, vessels and speed by hour of day, level and region; all history when ``as_of`` is None."""
    rows = _in_waters(density, "lat_bin", "lon_bin")
    if as_of is not None:
        rows = rows.filter(F.col("hour_bucket") >= days_before(as_of.cast("date").cast("timestamp_ntz"), days))
    figures = [
        F.count("*").alias("grid_cells"),
        F.round(steady_avg("vessel_count"), 1).alias("avg_vessels_per_cell"),
        F.round(steady_avg("avg_sog", 6), 2).alias("avg_speed_kn"),
    ]
    if with_stopped:
        figures.append(F.sum("stopped_count").alias("total_stopped_vessels"))
    return (
        rows.groupBy(
            F.hour("hour_bucket").alias("hour_of_day"), "congestion_level",
            labels.region("lat_bin", "lon_bin", with_lakes).alias("us_region"),
        )
        .agg(*figures)
        .orderBy("us_region", "hour_of_day", "congestion_level")
    )


def risk_events(track: DataFrame, as_of: Column, days: int = 30, top_n: int = 25) -> DataFrame:
    """Vessels with most HIGH-risk reports and the region where most of them happened.

    Counted per (vessel, region) first: a vessel's reports reach the second step as at most five rows.
    """
    since = days_before(as_of.cast("date").cast("timestamp_ntz"), days)
    rows = _in_waters(track.filter(F.col("risk_level") == "HIGH"), "lat", "lon").filter(
        F.col("base_datetime") >= since
    )
    per_region = rows.groupBy("mmsi", labels.region("lat", "lon").alias("region")).agg(
        F.count("*").alias("n"), F.count("sog").alias("n_sog"), steady_sum("sog").alias("sog_sum"),
        F.max("base_datetime").alias("last"),
    )
    return (
        per_region.groupBy("mmsi")
        .agg(
            F.sum("n").alias("risk_count"),
            F.round(F.try_divide(F.round(F.sum("sog_sum"), 4), F.sum("n_sog")), 2).alias("avg_risk_sog"),
            F.max("last").alias("last_risk_event"),
            F.min_by("region", F.struct((-F.col("n")).alias("n"), F.col("region"))).alias("predominant_risk_zone"),
        )
        .orderBy(F.desc("risk_count"), "mmsi")
        .limit(top_n)
    )


def top_risky_vessels(
    track: DataFrame, dim: DataFrame, latest: DataFrame, as_of: Column, days: int = 30, top_n: int = 25,
) -> DataFrame:
    """The riskiest vessels with their dimension row and last position.

    The limit is applied before the joins, so that the driving side has the caller's ``top_n`` rows; Spark broadcasts
    them as long as they are few.
    """
    top = risk_events(track, as_of, days, top_n)
    return (
        dim.select("mmsi", "vessel_name", "vessel_type_label", "length", "draft")
        .join(top, "mmsi")
        .join(
            latest.select(
                "mmsi", F.col("lat").alias("last_lat"), F.col("lon").alias("last_lon"), F.col("sog").alias("last_sog")
            ).join(top.select("mmsi"), "mmsi"),
            "mmsi",
        )
        .orderBy(F.desc("risk_count"), "mmsi")
    )


def collision_stats(alerts: DataFrame, as_of: Column, weeks: int = 8) -> DataFrame:
    """Near misses by week (Monday), severity and region."""
    since = days_before(as_of.cast("date").cast("timestamp_ntz"), 7 * weeks)
    rows = _in_waters(alerts.filter(F.col("alert_type") == C.COLLISION_KIND), "lat", "lon").filter(
        F.col("created_at") >= since
    )
    return (
        rows.groupBy(
            cleaning.truncate_time("week", "created_at").alias("week_start"), "severity",
            labels.region("lat", "lon").alias("us_region"),
        )
        .agg(
            F.count("*").alias("collision_alerts"),
            F.countDistinct("mmsi_1").alias("vessels_involved"),
            F.round(steady_avg("distance_nm"), 3).alias("avg_cpa_nm"),
            F.count_if("is_resolved").alias("resolved"),
            F.count_if(~F.col("is_resolved")).alias("outstanding"),
        )
        .orderBy(F.desc("week_start"), F.desc("collision_alerts"), "severity", "us_region")
    )


def kpi_summary(latest: DataFrame, alerts: DataFrame, as_of: Column, days: int = 14) -> DataFrame:
    """Vessels, alerts, HIGH risk, anomalies, and mean speed over all vessels (unknown speed counts as 0)."""
    recent = alerts.filter(F.col("created_at") >= days_before(as_of, days)).agg(F.count("*")).scalar()
    return latest.agg(
        F.count("*").alias("total_vessels"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.round(
            F.try_divide(F.coalesce(steady_sum("sog"), F.lit(0.0)), F.greatest(F.count("*"), F.lit(1))), 2
        ).alias("avg_speed_kn"),
    ).withColumn("total_alerts", recent)


def distribution(df: DataFrame, column: str, unknown: str | None = None, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; null and '' become ``unknown`` when it is given."""
    value = F.col(column) if unknown is None else F.expr(f"coalesce(nullif({column}, ''), '{unknown}')")
    counted = df.groupBy(value.alias(column)).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)
    return counted if top is None else counted.limit(top)


def share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of all rows. The total comes from the counts, not from a second scan."""
    counted = df.groupBy(column).agg(F.count("*").alias("count"))
    total = counted.agg(F.sum("count")).scalar()
    return counted.withColumn("share", F.round(F.col("count") / total, 6))


def speed_histogram(rows: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins between the smallest and the largest speed, empty bins left out."""
    known = rows.filter(F.col("sog").isNotNull()).groupBy("sog").agg(F.count("*").alias("n"))
    span = known.agg(F.struct(F.min("sog").alias("low"), F.max("sog").alias("high"))).scalar()
    placed = known.withColumn(
        "bin", F.least(F.width_bucket("sog", span["low"], span["high"], F.lit(bins)), F.lit(bins).cast("bigint"))
    )
    return placed.groupBy("bin").agg(
        F.sum("n").alias("count"), F.min("sog").alias("min_sog"), F.max("sog").alias("max_sog")
    )


def alert_counters(alerts: DataFrame) -> DataFrame:
    """Alerts by severity and how many are resolved, in one row."""
    severities = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
    return alerts.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("severity") == s).alias(s.lower()) for s in severities],
        F.count_if("is_resolved").alias("resolved"),
    )


def fleet_counters(latest: DataFrame) -> DataFrame:
    """Header figures of the map."""
    return latest.agg(
        F.count("*").alias("total_vessels"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.round(F.try_divide(steady_sum("coalesce(sog, 0D)"), F.count("*")), 1).alias("avg_speed_kn"),
    )


def anomaly_counters(alerts: DataFrame) -> DataFrame:
    kinds = alerts.filter(F.col("alert_type").isin(*C.ANOMALY_KINDS))
    return kinds.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
        F.count_if(F.col("severity") == "MEDIUM").alias("medium"),
        F.count_if(F.col("alert_type") == "ML_ANOMALY").alias("ml_detected"),
    )


def zone_counters(density: DataFrame) -> DataFrame:
    return density.agg(
        F.count_if(F.col("congestion_level") == "HIGH").alias("high_zones"),
        F.count_if(F.col("congestion_level") == "MEDIUM").alias("medium_zones"),
    )


def profile(rows: DataFrame) -> DataFrame:
    """Rows and distinct vessels, in one pass."""
    return rows.agg(F.count("*").alias("total_rows"), F.countDistinct("mmsi").alias("total_vessels"))


def region_totals(report: DataFrame, value: str, by: Sequence[str] = ("us_region",), mean: bool = False) -> DataFrame:
    """Second-level totals or means of a report by region (and hour)."""
    figure = F.round(steady_avg(value, 6), 6) if mean else F.sum(value)
    return report.groupBy(*by).agg(figure.alias(value))


def daily_with_collisions(daily: DataFrame, alerts: DataFrame) -> DataFrame:
    """Daily statistics with the number of near misses of the day."""
    per_day = (
        alerts.filter(F.col("alert_type") == C.COLLISION_KIND)
        .groupBy(F.to_date("created_at").alias("stat_date"))
        .agg(F.count("*").alias("__n"))
    )
    return daily.join(per_day, "stat_date", "left").withColumn("collision_alerts", F.coalesce("__n", F.lit(0))).drop("__n")


def zscore(daily: DataFrame, metric: str, threshold: float = 3.0) -> DataFrame:
    """Each day's metric against itself and up to seven days before; needs three earlier days.

    The input has one row per calendar day, so one ordered pass over it is small by nature.
    """
    w = Window.orderBy("stat_date").rowsBetween(-7, 0)
    return daily.select("stat_date", F.col(metric).cast("double").alias("value")).withColumns({
        "days": F.count("*").over(w), "mean": F.avg("value").over(w), "spread": F.stddev_pop("value").over(w),
    }).select(
        "stat_date", "value",
        F.when((F.col("days") >= 4) & (F.col("spread") > 1e-9), F.round((F.col("value") - F.col("mean")) / F.col("spread"), 4))
        .alias("z"),
    ).withColumn("is_outlier", F.coalesce(F.abs("z") > threshold, F.lit(False)))
