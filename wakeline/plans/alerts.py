"""Rule anomalies, model merge and the alert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Thresholds
from wakeline.functions import cleaning, geo, labels
from wakeline.operators import tracks

# Heading, else course, else 0; zero counts as missing.
HEADING_OR_COURSE = "coalesce(nullif(heading, 0D), nullif(cog, 0D), 0D)"
ALERT_COLUMNS = (
    "id", "alert_type", "severity", "mmsi_1", "mmsi_2", "vessel_name_1", "vessel_name_2", "lat", "lon",
    "description", "anomaly_score", "distance_nm", "is_resolved", "created_at", "data_split",
)


def batch_motion(rows: DataFrame) -> DataFrame:
    """Motion deltas of a bare batch: 0 for a vessel's first row, heading by modulo, distance unrounded."""
    linked = tracks.with_neighbour(rows, ("lat", "lon", "sog", "heading"))
    prev = F.col("prev")
    distance = geo.haversine_nm("prev.lat", "prev.lon", "lat", "lon")
    return linked.withColumns({
        "sog_change": F.coalesce(F.col("sog") - prev["sog"], F.lit(0.0)),
        "heading_change": geo.turn_modulo("coalesce(heading - prev.heading, 0D)"),
        "distance_nm": F.coalesce(distance, F.lit(0.0)),
    }).drop("prev")


def rule_anomalies(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """is_anomaly, anomaly_score, anomaly_type. Where several rules hold, the last one listed decides."""
    sog, turn = F.col("sog"), F.col("heading_change")
    rules: list[tuple[str, Column, Column]] = [
        ("SUDDEN_STOP", F.col("sog_change") < -t.sudden_stop_kn, F.lit(0.8)),
        ("UNUSUAL_SPEED", sog > t.speeding_kn, sog / F.lit(60.0)),
        ("SHARP_TURN", (turn > t.sharp_turn_deg) & (sog > t.sharp_turn_min_sog), F.least(turn / F.lit(180.0), F.lit(1.0))),
    ]
    if "in_us_port_zone" in rows.columns:
        rules.append(("STATIONARY_RISK", (sog < t.stopped_kn) & F.col("in_us_port_zone"), F.lit(0.9)))
    kind, score = F.lit(""), F.lit(0.0)
    for name, holds, value in rules:
        kind = F.when(holds, name).otherwise(kind)
        score = F.when(holds, value).otherwise(score)
    return rows.withColumns({"anomaly_type": kind, "anomaly_score": score}).withColumn(
        "is_anomaly", F.col("anomaly_type") != ""
    )


def rule_labels(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Training labels: stop, turn, speed, reporting gap; the later rule names the type."""
    sog = F.col("sog")
    gap = F.col("time_delta_sec") > t.gap_seconds
    turn = (F.abs("heading_change") > t.sharp_turn_deg) & (sog > t.sharp_turn_min_sog)
    stop = F.col("sog_change") < -t.sudden_stop_kn
    kind = (
        F.when(gap, "AIS_GAP").when(sog > t.speeding_kn, "UNUSUAL_SPEED").when(turn, "SHARP_TURN")
        .when(stop, "SUDDEN_STOP").otherwise("")
    )
    return rows.withColumn("rule_type", kind).withColumn("rule_anomaly", F.col("rule_type") != "")


def normalise_scores(rows: DataFrame, raw: str = "raw_score", low: float | None = None, high: float | None = None) -> DataFrame:
    """Raw outlier scores (higher = more normal) to 0..1 (1 = most abnormal).

    Without ``low``/``high`` the range of this batch is used, read by a scalar subquery.
    """
    span = rows.agg(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi"))).scalar()
    lo = span["lo"] if low is None else F.lit(low)
    hi = span["hi"] if high is None else F.lit(high)
    return rows.withColumn("norm", 1 - (F.col(raw) - lo) / (hi - lo + F.lit(1e-9)))


def merge_model(rows: DataFrame) -> DataFrame:
    """Raises a rule score where the model calls an outlier (``outlier``) with a higher ``norm``."""
    upgrade = F.coalesce(F.col("outlier") & (F.col("norm") > F.col("anomaly_score")), F.lit(False))
    return rows.withColumns({
        "is_anomaly": F.col("is_anomaly") | upgrade,
        "anomaly_type": F.when(upgrade & (F.col("anomaly_type") == ""), "ML_ANOMALY").otherwise(F.col("anomaly_type")),
        "anomaly_score": F.when(upgrade, F.col("norm")).otherwise(F.col("anomaly_score")),
    })


def alert_id(kind: Column, mmsi_1: str, mmsi_2: Column, at: str) -> Column:
    """What an alert is about names it: kind, vessels and second."""
    return cleaning.content_id(kind, mmsi_1, mmsi_2, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))


def anomaly_alerts(scored: DataFrame) -> DataFrame:
    """One alert per anomalous row, unresolved."""
    kind = "coalesce(nullif(anomaly_type, ''), 'ML_ANOMALY')"
    return scored.filter("is_anomaly").select(
        alert_id(F.expr(kind), "mmsi", F.lit(""), "base_datetime").alias("id"),
        F.expr(kind).alias("alert_type"),
        labels.alert_severity("anomaly_score").alias("severity"),
        F.col("mmsi").alias("mmsi_1"),
        F.col("vessel_name").alias("vessel_name_1"),
        "lat", "lon",
        labels.anomaly_text(kind, "mmsi", "anomaly_score").alias("description"),
        "anomaly_score",
        F.col("base_datetime").alias("created_at"),
        F.lit(False).alias("is_resolved"),
    )


def collision_alerts(pairs: DataFrame) -> DataFrame:
    """One alert per near miss, unresolved."""
    return pairs.select(
        alert_id(F.col("alert_type"), "mmsi_1", F.col("mmsi_2"), "detected_at").alias("id"),
        "alert_type", "severity", "mmsi_1", "mmsi_2", "vessel_name_1", "vessel_name_2", "lat", "lon",
        "description", "distance_nm",
        F.col("detected_at").alias("created_at"),
        F.lit(False).alias("is_resolved"),
    )


def with_alert_defaults(alerts: DataFrame) -> DataFrame:
    """The stored form: missing columns and empty fields take the defaults of the alert table."""
    kinds = {"mmsi_2": "string", "vessel_name_2": "string", "anomaly_score": "double", "distance_nm": "double"}
    absent = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in alerts.columns}
    df = alerts.withColumns(absent) if absent else alerts
    resolved = F.col("is_resolved") if "is_resolved" in df.columns else F.lit(None).cast("boolean")
    return df.withColumns({
        "is_resolved": F.coalesce(resolved, F.lit(False)),
        "alert_type": F.coalesce("alert_type", F.lit("ML_ANOMALY")),
        "severity": F.coalesce("severity", F.lit("MEDIUM")),
        "data_split": F.lit("live"),
    }).select(*ALERT_COLUMNS)


def alert_table(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    return with_alert_defaults(anomaly_alerts(scored)).unionByName(with_alert_defaults(collision_alerts(pairs)))


def gold_anomalies(scored: DataFrame) -> DataFrame:
    """The Gold anomaly table."""
    return scored.filter("is_anomaly").select(
        "mmsi", "vessel_name", "lat", "lon", "anomaly_type", "anomaly_score", "sog", "heading_change",
        "risk_level", "base_datetime", "data_split",
    )


def predict_positions(rows: DataFrame, minutes: int = 5, min_sog: float | None = None) -> DataFrame:
    """Dead reckoning when no model is loaded: position, method and confidence."""
    lat, lon = geo.dead_reckoning(
        "coalesce(lat, 0D)", "coalesce(lon, 0D)", "coalesce(sog, 0D)", HEADING_OR_COURSE, minutes
    )
    moving = F.lit(True) if min_sog is None else F.col("sog") >= min_sog
    return rows.withColumns({
        "predicted_lat": F.when(moving, lat),
        "predicted_lon": F.when(moving, lon),
        "method": F.when(moving, "dead_reckoning"),
        "minutes_ahead": F.lit(minutes),
        "confidence": F.when(moving, 0.65),
    })


def heading_or_course() -> Column:
    return F.expr(HEADING_OR_COURSE)


def resolve(alerts: DataFrame, alert_id: int, at: Column) -> DataFrame:
    """The alert table with one alert marked resolved."""
    hit = F.col("id") == alert_id
    before = F.col("resolved_at") if "resolved_at" in alerts.columns else F.lit(None).cast("timestamp_ntz")
    return alerts.withColumns({
        "is_resolved": F.col("is_resolved") | hit,
        "resolved_at": F.when(hit, at).otherwise(before),
    })

