"""Parameterised look-ups over the served tables (latest, track, alerts, density, statistics).

Optional filters and limits that are None are left out. "Last N hours" is relative to an explicit ``as_of``.
Every result that may be limited has a full order, so it is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import labels
from wakeline.plans.alerts import heading_or_course

HOUR = "INTERVAL '1' HOUR"


def hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.expr(f"make_dt_interval(0, {int(hours)}, 0, 0)")


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.expr(f"make_dt_interval({int(days)}, 0, 0, 0)")


def _only(df: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def check_range(name: str, value: int, low: int, high: int) -> int:
    """A bounded request parameter."""
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, got {value}")
    return value


def vessels(
    latest: DataFrame, vessel_type: str | None = None, risk_level: str | None = None, min_sog: float = 0.0,
    max_sog: float = 60.0, is_anomaly: bool | None = None, data_split: str | None = None, limit: int | None = None,
) -> DataFrame:
    """The live map: latest positions, unknown speed passes the speed range."""
    df = _only(latest, vessel_type=vessel_type, risk_level=risk_level, is_anomaly=is_anomaly, data_split=data_split)
    df = df.filter(F.col("sog").isNull() | F.col("sog").between(min_sog, max_sog))
    return _limited(df.orderBy("mmsi"), limit).select(
        "mmsi", "vessel_name", "vessel_type", labels.vessel_type_ranges("vessel_type").alias("vessel_type_label"),
        "lat", "lon", "sog", "cog", heading_or_course().alias("heading"), "risk_level", "is_anomaly",
        "anomaly_score", "anomaly_type", "predicted_lat", "predicted_lon", "updated_at",
    )


def screen_filter(latest: DataFrame, low: float, high: float, risks=(), types=()) -> DataFrame:
    """The screen filter: an empty choice means no filter, unknown speed does not pass."""
    df = latest.filter(F.col("sog").between(low, high))
    if risks:
        df = df.filter(F.col("risk_level").isin(*risks))
    if types:
        df = df.filter(F.col("vessel_type").isin(*types))
    return df


def search(
    latest: DataFrame, text: str, vessel_type: str | None = None, risk_level: str | None = None,
    min_speed: float = 0.0, max_speed: float = 60.0, limit: int | None = None,
) -> DataFrame:
    """Case-insensitive substring of mmsi or name."""
    if len(text) < 2:
        raise ValueError("the search text needs two characters or more")
    needle = F.lit(text.lower())
    df = latest.filter(
        F.contains(F.lower("mmsi"), needle) | F.contains(F.lower("vessel_name"), needle)
    ).filter(F.col("sog").between(min_speed, max_speed))
    return _limited(_only(df, vessel_type=vessel_type, risk_level=risk_level).orderBy("mmsi"), limit)


def track(
    rows: DataFrame, mmsi: str, start: Column | None = None, end: Column | None = None,
    data_split: str | None = None, limit: int | None = None,
) -> DataFrame:
    """One vessel in time order."""
    df = rows.filter(F.col("mmsi") == mmsi)
    if start is not None:
        df = df.filter(F.col("base_datetime") >= start)
    if end is not None:
        df = df.filter(F.col("base_datetime") <= end)
    return _limited(_only(df, data_split=data_split).orderBy("base_datetime"), limit)


def snapshot(rows: DataFrame, at: Column, vessel_type: str | None = None, limit: int | None = None) -> DataFrame:
    """Reports within five minutes of a moment."""
    span = F.expr("INTERVAL '5' MINUTE")
    df = _only(rows.filter(F.col("base_datetime").between(at - span, at + span)), vessel_type=vessel_type)
    return _limited(df.orderBy("base_datetime", "mmsi"), limit).select(
        "mmsi", "lat", "lon", "sog",
        F.coalesce(F.nullif("heading", F.lit(0.0)), F.col("cog")).alias("heading"),
        "vessel_type", "risk_level",
    )


def recent_alerts(
    alerts: DataFrame, as_of: Column, hours: int = 24, alert_type: str | None = None, severity: str | None = None,
    is_resolved: bool | None = None, limit: int | None = None,
) -> DataFrame:
    df = alerts.filter(F.col("created_at") >= hours_before(as_of, hours))
    df = _only(df, alert_type=alert_type, severity=severity, is_resolved=is_resolved)
    return _limited(df.orderBy(F.desc("created_at"), "id"), limit)


def recent_anomalies(
    alerts: DataFrame, as_of: Column, hours: int = 24, alert_type: str | None = None, severity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Alerts of the six anomaly kinds."""
    kinds = alerts.filter(F.col("alert_type").isin(*C.ANOMALY_KINDS))
    return recent_alerts(kinds, as_of, hours, alert_type, severity, None, limit)


def recent_other_than_collisions(alerts: DataFrame, as_of: Column, hours: int = 24, limit: int | None = None) -> DataFrame:
    return recent_alerts(alerts.filter(F.col("alert_type") != C.COLLISION_KIND), as_of, hours, limit=limit)


def open_collisions(
    alerts: DataFrame, as_of: Column, hours: int = 6, severity: str | None = None, lexical: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Unresolved near misses, gravest first (``lexical`` orders severities by spelling instead).

    Alerts that are ``dealt`` lie in partitions by severity and time, as ``proximity.near_misses_in_order`` leaves them;
    each partition is then sorted on its own.
    """
    df = alerts.filter(
        (F.col("created_at") >= hours_before(as_of, hours))
        & (F.col("alert_type") == C.COLLISION_KIND) & ~F.col("is_resolved")
    )
    if dealt and lexical:
        raise ValueError("dealt alerts lie in the order of severity, not of its spelling")
    if dealt:
        return _only(df, severity=severity).sortWithinPartitions(F.desc("created_at"), "id")
    rank = F.col("severity") if lexical else labels.ordinal("severity")
    return _only(df, severity=severity).orderBy(rank.desc(), F.desc("created_at"), "id")


def congestion_zones(density: DataFrame, as_of: Column, level: str | None = None, limit: int | None = None) -> DataFrame:
    """Cells of the last hour with more than three reports."""
    df = density.filter((F.col("hour_bucket") >= hours_before(as_of, 1)) & (F.col("vessel_count") > 3))
    found = _only(df, congestion_level=level).orderBy(
        F.desc("vessel_count"), "lat_bin", "lon_bin", "hour_bucket", "data_split"
    )
    return _limited(found, limit).select(
        F.col("lat_bin").alias("lat"), F.col("lon_bin").alias("lon"), F.col("vessel_count").alias("count"),
        F.col("congestion_level").alias("level"), "avg_sog",
    )


def recent_days(daily: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Daily statistics of the last days, oldest first."""
    return daily.filter(F.col("stat_date") >= F.date_sub(as_of.cast("date"), days)).orderBy("stat_date", "data_split")


def vessel_card(latest: DataFrame, dim: DataFrame, mmsi: str | None = None) -> DataFrame:
    """Latest position with the vessel's dimension row, nulls where there is none."""
    card = dim.select(
        "mmsi", "imo", "call_sign", "length", "width", "draft", "cargo", "total_records", "first_seen"
    )
    return _only(latest, mmsi=mmsi).join(card, "mmsi", "left")


def named_track(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Track rows with the display name, the mmsi where the name is missing or empty."""
    names = latest.select("mmsi", F.col("vessel_name").alias("__name"))
    return rows.join(names, "mmsi", "left").withColumn(
        "display_name", F.expr("coalesce(nullif(__name, ''), mmsi)")
    ).drop("__name")


def balanced_cells(peaks: DataFrame, quota: dict[str, int] | None = None) -> DataFrame:
    """The busiest cells of every level up to its quota, in one pass (group limit before the exchange)."""
    from pyspark.sql import Window

    quota = quota or {"HIGH": 700, "MEDIUM": 200, "LOW": 100}
    w = Window.partitionBy("congestion_level").orderBy(F.desc("vessel_count"), "lat_bin", "lon_bin")
    wanted = " OR ".join(f"(congestion_level = '{k}' AND __rn <= {n})" for k, n in quota.items())
    return (
        peaks.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") <= max(quota.values()))
        .filter(wanted)
        .drop("__rn")
    )


def balanced_cells_union(peaks: DataFrame, quota: dict[str, int] | None = None) -> DataFrame:
    """The same as a union of one limited query per level."""
    quota = quota or {"HIGH": 700, "MEDIUM": 200, "LOW": 100}
    parts = [
        peaks.filter(F.col("congestion_level") == level)
        .orderBy(F.desc("vessel_count"), "lat_bin", "lon_bin").limit(n)
        for level, n in quota.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def density_map(
    density: DataFrame, track_rows: DataFrame, as_of: Column, hours: int = 24, min_vessels: int = 1,
) -> DataFrame:
    """Heat-map cells: the recent window, else all density, else the raw track; a flag says which.

    Each step of the fallback asks only whether any row exists.
    """
    from wakeline.operators import density as ops

    def shaped(rows: DataFrame, fallback: bool) -> DataFrame:
        cells = ops.heat_weight(balanced_cells(ops.peak_hours(rows, min_vessels)))
        return cells.select(
            F.col("lat_bin").alias("lat"), F.col("lon_bin").alias("lon"), "vessel_count", "avg_sog",
            "congestion_level", "weight", F.lit(fallback).alias("is_historical_fallback"),
        )

    busy = density.filter(F.col("vessel_count") >= min_vessels)
    recent = density.filter(F.col("hour_bucket") >= hours_before(as_of, hours))
    if not recent.filter(F.col("vessel_count") >= min_vessels).isEmpty():
        return shaped(recent, False)
    if not busy.isEmpty():
        return shaped(density, True)
    return ops.raw_track_density(track_rows).withColumn("is_historical_fallback", F.lit(True))
