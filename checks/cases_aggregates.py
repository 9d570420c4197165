"""AG-*: grouped reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql, testbed
from checks.registry import case
from checks.sql import AS_OF, avg, dec, total
from wakeline.config import Thresholds
from wakeline.operators import density as density_ops
from wakeline.plans import alerts, analytics, gold, warehouse, weather

MIDNIGHT = f"date_trunc('day', {AS_OF})"


@case("ag_01_traffic_density", sql.over("SELECT * FROM density"))
def _(t):
    return density_ops.traffic_density(t.silver)


@case("ag_01b_traffic_density_lowered", sql.over(
    f"SELECT * REPLACE ({sql.level('vessel_count', 5, 2)} AS congestion_level) FROM density"))
def _(t):
    return density_ops.traffic_density(t.silver, Thresholds(congestion_high=5, congestion_medium=2))


@case("ag_02_density_truncated", sql.over(f"""
SELECT *, {sql.level("vessel_count")} AS congestion_level FROM (
  SELECT {sql.truncated("lat", "0.1")} AS lat_grid, {sql.truncated("lon", "0.1")} AS lon_grid,
    date_trunc('hour', base_datetime) AS hour_bucket, count(mmsi) AS vessel_count, count(DISTINCT mmsi) AS unique_vessels,
    {avg("sog")} AS avg_sog, CAST(sum(CAST(is_stopped AS INTEGER)) AS BIGINT) AS stopped_count
  FROM silver GROUP BY 1, 2, 3)"""))
def _(t):
    return density_ops.traffic_density_truncated(t.silver)


TRAINING = f"""
SELECT *, CAST(hour(hour_bucket) AS INTEGER) AS hour, CAST(isodow(hour_bucket) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(hour_bucket) >= 6 AS INTEGER) AS is_weekend, {sql.level("vessel_count", 3, 2)} AS congestion_level FROM (
  SELECT CAST(trunc(lat / CAST(0.1 AS DOUBLE)) AS BIGINT) AS lat_cell, CAST(trunc(lon / CAST(0.1 AS DOUBLE)) AS BIGINT) AS lon_cell,
    {sql.truncated("lat", "0.1")} AS lat_bin, {sql.truncated("lon", "0.1")} AS lon_bin,
    date_trunc('hour', base_datetime) AS hour_bucket, count(DISTINCT mmsi) AS vessel_count, {avg("sog")} AS avg_sog,
    count(*) FILTER (WHERE sog < 0.5) AS stopped_count
  FROM silver GROUP BY ALL)"""
LOWERED = Thresholds(congestion_high=3, congestion_medium=2)


@case("ag_03_training_density", sql.over("SELECT * FROM training", training=TRAINING))
def _(t):
    return density_ops.training_density(t.silver, LOWERED)


@case("ag_04_daily_stats", sql.over("SELECT * FROM daily"))
def _(t):
    return gold.daily_stats(t.silver)


@case("ag_05_daily_stats_plain", sql.over(f"""
SELECT CAST(base_datetime AS DATE) AS stat_date, count(DISTINCT mmsi) AS total_vessels, count(*) AS total_records,
  {avg("sog")} AS avg_sog, max(sog) AS max_sog, count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count,
  CAST(sum(CAST(is_stopped AS INTEGER)) AS BIGINT) AS stopped_vessels, CAST(0 AS INTEGER) AS anomaly_count
FROM silver GROUP BY 1 ORDER BY 1"""))
def _(t):
    return gold.daily_stats_plain(t.silver)


@case("ag_06_dim_vessel", sql.over("SELECT * FROM dim_vessel"))
def _(t):
    return gold.dim_vessel(t.silver)


_FIRST = ", ".join(
    f"arg_min({c}, base_datetime) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in ("vessel_name", "imo", "call_sign", "vessel_type", "vessel_type_label", "cargo", "transceiver_class",
              "length", "width", "draft"))


@case("ag_07_dim_vessel_first_known", sql.over(f"""
SELECT mmsi, {_FIRST}, min(base_datetime) AS first_seen, max(base_datetime) AS last_seen, count(*) AS total_records
FROM silver GROUP BY mmsi"""))
def _(t):
    return gold.dim_vessel_first_known(t.silver)


_KPI = f"""count(DISTINCT mmsi) AS total_vessels,
  count(DISTINCT CASE WHEN risk_level = 'HIGH' THEN mmsi END) AS high_risk_vessels,
  count(DISTINCT CASE WHEN is_anomaly THEN mmsi END) AS anomalous_vessels, {dec(avg("sog"), 2)} AS fleet_avg_speed_kn,
  count(DISTINCT CASE WHEN lon BETWEEN -82 AND -66 THEN mmsi END) AS east_coast_vessels,
  count(DISTINCT CASE WHEN lon BETWEEN -125 AND -117 THEN mmsi END) AS west_coast_vessels,
  count(DISTINCT CASE WHEN lon BETWEEN -97 AND -80 AND lat BETWEEN 24 AND 31 THEN mmsi END) AS gulf_vessels,
  max(updated_at) AS data_freshness"""


@case("ag_08_fleet_kpis", sql.over(
    f"SELECT {_KPI}, count(DISTINCT vessel_type) AS vessel_type_diversity FROM latest WHERE {sql.us('lat', 'lon')}"))
def _(t):
    return analytics.fleet_kpis(t.latest)


@case("ag_08b_fleet_kpis_plain", sql.over(f"SELECT {_KPI} FROM latest WHERE {sql.us('lat', 'lon')}"))
def _(t):
    return analytics.fleet_kpis(t.latest, with_diversity=False)


def _lanes(peak: str, days: str, limit: int = 50) -> str:
    return f"""
SELECT {dec("lat_bin", 1)} AS lat_grid, {dec("lon_bin", 1)} AS lon_grid, CAST(sum(vessel_count) AS BIGINT) AS total_vessels,
  CAST(sum(unique_vessels) AS BIGINT) AS unique_vessels, {dec(avg("avg_sog", 6), 2)} AS avg_speed_kn,
  {peak} AS peak_congestion, {sql.region("lat_bin", "lon_bin")} AS us_region{days}
FROM density WHERE {sql.us("lat_bin", "lon_bin")} GROUP BY 1, 2, 7 ORDER BY total_vessels DESC, 1, 2 LIMIT {limit}"""


_BY_MEANING = ("CASE max(CASE congestion_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END) "
               "WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END")
_DAYS = ", count(DISTINCT CAST(hour_bucket AS DATE)) AS active_days"


@case("ag_09_busiest_lanes", sql.over(_lanes(_BY_MEANING, _DAYS)))
def _(t):
    return analytics.busiest_lanes(t.density)


@case("ag_09b_busiest_lanes_lexical", sql.over(_lanes("max(congestion_level)", "", 200)))
def _(t):
    return analytics.busiest_lanes(t.density, 200, with_days=False, lexical=True)


@case("ag_10_anomaly_trends", sql.over(f"""
SELECT date_trunc('day', base_datetime)::TIMESTAMP AS event_date, anomaly_type, count(*) AS anomaly_count,
  {dec(avg("anomaly_score", 6), 4)} AS avg_score, count(DISTINCT mmsi) AS unique_vessels, {sql.region("lat", "lon")} AS us_region
FROM scored WHERE is_anomaly AND {sql.us("lat", "lon")} AND base_datetime >= {MIDNIGHT} - INTERVAL 20 DAY
GROUP BY 1, 2, 6"""))
def _(t):
    return analytics.anomaly_trends(t.scored, t.as_of, 20)


def _hours(stopped: str, lakes: bool, since: str) -> str:
    return f"""
SELECT CAST(hour(hour_bucket) AS INTEGER) AS hour_of_day, congestion_level, count(*) AS grid_cells,
  {dec(avg("vessel_count"), 1)} AS avg_vessels_per_cell, {dec(avg("avg_sog", 6), 2)} AS avg_speed_kn{stopped},
  {sql.region("lat_bin", "lon_bin", lakes)} AS us_region
FROM density WHERE {sql.us("lat_bin", "lon_bin")} {since} GROUP BY 1, 2, us_region"""


_HOURS_FULL = _hours(", CAST(sum(stopped_count) AS BIGINT) AS total_stopped_vessels", True,
                     f"AND hour_bucket >= {MIDNIGHT} - INTERVAL 14 DAY")


@case("ag_11_congestion_by_hour", sql.over(_HOURS_FULL))
def _(t):
    return analytics.congestion_by_hour(t.density, t.as_of)


@case("ag_11b_congestion_by_hour_all", sql.over(_hours("", False, "")))
def _(t):
    return analytics.congestion_by_hour(t.density, with_lakes=False, with_stopped=False)


RISKY = f"""
SELECT mmsi, count(*) AS risk_count, {dec(total("sog") + " / count(sog)", 2)} AS avg_risk_sog,
  max(base_datetime) AS last_risk_event
FROM silver WHERE risk_level = 'HIGH' AND {sql.us("lat", "lon")} AND base_datetime >= {MIDNIGHT} - INTERVAL 30 DAY
GROUP BY mmsi"""
ZONES = f"""
SELECT mmsi, region AS predominant_risk_zone FROM (
  SELECT mmsi, region, row_number() OVER (PARTITION BY mmsi ORDER BY count(*) DESC, region) AS rn FROM (
    SELECT mmsi, {sql.region("lat", "lon")} AS region FROM silver
    WHERE risk_level = 'HIGH' AND {sql.us("lat", "lon")} AND base_datetime >= {MIDNIGHT} - INTERVAL 30 DAY)
  GROUP BY mmsi, region) WHERE rn = 1"""


@case("ag_12_risk_events", sql.over(
    "SELECT * FROM risky JOIN zones USING (mmsi) ORDER BY risk_count DESC, mmsi LIMIT 10", risky=RISKY, zones=ZONES))
def _(t):
    return analytics.risk_events(t.silver, t.as_of, top_n=10)


COLLISIONS = f"""
SELECT date_trunc('week', created_at)::TIMESTAMP AS week_start, severity, count(*) AS collision_alerts,
  count(DISTINCT mmsi_1) AS vessels_involved, {dec(avg("distance_nm"), 3)} AS avg_cpa_nm,
  count(*) FILTER (WHERE is_resolved) AS resolved, count(*) FILTER (WHERE NOT is_resolved) AS outstanding,
  {sql.region("lat", "lon")} AS us_region
FROM alerts WHERE alert_type = 'COLLISION_RISK' AND {sql.us("lat", "lon")} AND created_at >= {MIDNIGHT} - INTERVAL 56 DAY
GROUP BY 1, 2, us_region"""


@case("ag_13_collision_stats", sql.over(COLLISIONS))
def _(t):
    return analytics.collision_stats(t.alerts, t.as_of)


@case("ag_14_fleet_by_region", sql.over(f"""
SELECT {sql.region("lat", "lon")} AS us_region, count(DISTINCT mmsi) AS total_vessels,
  count(DISTINCT CASE WHEN risk_level = 'HIGH' THEN mmsi END) AS high_risk_vessels,
  count(DISTINCT CASE WHEN is_anomaly THEN mmsi END) AS anomalous_vessels, {dec(avg("sog"), 2)} AS avg_speed_kn,
  max(updated_at) AS data_freshness FROM latest GROUP BY 1"""))
def _(t):
    return warehouse.fleet_by_region(t.latest)


@case("ag_15_weekly_trend", sql.over(f"""
SELECT date_trunc('week', stat_date)::TIMESTAMP AS week_start, CAST(sum(total_vessels) AS BIGINT) AS total_vessels,
  CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies, CAST(sum(high_risk_count) AS BIGINT) AS total_high_risk,
  CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_collisions, {dec(avg("avg_sog", 6), 2)} AS avg_fleet_speed
FROM daily LEFT JOIN (SELECT CAST(created_at AS DATE) AS stat_date, count(*) AS n FROM alerts
  WHERE alert_type = 'COLLISION_RISK' GROUP BY 1) USING (stat_date) GROUP BY 1"""))
def _(t):
    return warehouse.weekly_trend(analytics.daily_with_collisions(t.daily, t.alerts))


@case("ag_16_kpi_summary", sql.over(f"""
SELECT count(*) AS total_vessels, count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count,
  count(*) FILTER (WHERE is_anomaly) AS anomaly_count, {dec(total("sog") + " / greatest(count(*), 1)", 2)} AS avg_speed_kn,
  (SELECT count(*) FROM alerts WHERE created_at >= {AS_OF} - INTERVAL 14 DAY) AS total_alerts FROM latest"""))
def _(t):
    return analytics.kpi_summary(t.latest, t.alerts, t.as_of)


_SPARSE = "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '' ELSE vessel_type END"


@case("ag_17_vessel_types", sql.over(f"""
SELECT coalesce(nullif({_SPARSE}, ''), 'Unknown') AS vessel_type, count(*) AS count FROM newest
GROUP BY 1 ORDER BY count DESC, vessel_type LIMIT 10"""))
def _(t):
    return analytics.distribution(t.newest.withColumn("vessel_type", F.expr(_SPARSE)), "vessel_type", "Unknown", 10)


@case("ag_17b_vessel_types_top8", sql.over("""
SELECT coalesce(nullif(vessel_type, ''), 'Unknown') AS vessel_type, count(*) AS count FROM latest
GROUP BY 1 ORDER BY count DESC, vessel_type LIMIT 8"""))
def _(t):
    return analytics.distribution(t.latest, "vessel_type", "Unknown", 8)


@case("ag_18_alert_types", sql.over(
    f"SELECT alert_type, count(*) AS count FROM alerts WHERE created_at >= {AS_OF} - INTERVAL 14 DAY GROUP BY 1"))
def _(t):
    recent = t.alerts.filter(F.col("created_at") >= t.as_of - F.expr("INTERVAL '14' DAY"))
    return analytics.distribution(recent, "alert_type")


@case("ag_19_risk_levels", sql.over("SELECT risk_level, count(*) AS count FROM latest GROUP BY 1"))
def _(t):
    return analytics.distribution(t.latest, "risk_level")


@case("ag_20_speed_histogram", sql.over("""
SELECT least(CAST(floor((sog - lo) / ((hi - lo) / 30)) AS BIGINT) + 1, 30) AS bin, count(*) AS count, min(sog) AS min_sog,
  max(sog) AS max_sog
FROM silver, (SELECT min(sog) AS lo, max(sog) AS hi FROM silver) WHERE sog IS NOT NULL GROUP BY 1"""))
def _(t):
    return analytics.speed_histogram(t.silver)


@case("ag_21_raw_track_density", sql.over(f"""
SELECT lat, lon, vessel_count, coalesce(avg_sog, 0) AS avg_sog, {sql.level("vessel_count", 10000, 1000)} AS congestion_level,
  least(CAST(vessel_count AS DOUBLE) / max(vessel_count) OVER (), 1) AS weight FROM (
  SELECT {dec("lat", 1)} AS lat, {dec("lon", 1)} AS lon, count(*) AS vessel_count, {avg("sog")} AS avg_sog
  FROM silver GROUP BY 1, 2 ORDER BY vessel_count DESC, 1, 2 LIMIT 1000)"""))
def _(t):
    return density_ops.raw_track_density(t.silver, 1000)


@case("ag_22_live_heat", sql.over(f"""
SELECT *, {sql.level("vessel_count", 10, 5)} AS congestion_level FROM (
  SELECT {sql.truncated("lat", "0.5", 1)} AS lat, {sql.truncated("lon", "0.5", 1)} AS lon,
    count(DISTINCT mmsi) AS vessel_count, {avg("sog")} AS avg_sog FROM silver GROUP BY 1, 2)"""))
def _(t):
    return density_ops.live_heat(t.silver)


@case("ag_23_hourly_weather", sql.over("SELECT lat_cell, lon_cell, hour_bucket, wind_speed_10m, wave_height FROM weather"))
def _(t):
    return weather.hourly_weather(testbed.weather(t.silver))


@case("ag_24_severity_profile", sql.over(f"""
SELECT min(weather_severity) AS sev_min, {dec(avg("weather_severity"), 4)} AS sev_mean, max(weather_severity) AS sev_max
FROM weather"""))
def _(t):
    return weather.severity_profile(t.weather)


MATCHED = f"""
SELECT d.*, w.weather_severity FROM density d LEFT JOIN weather w
  ON CAST(floor(d.lat_bin / CAST(0.5 AS DOUBLE)) AS BIGINT) = w.lat_cell
  AND CAST(floor(d.lon_bin / CAST(0.5 AS DOUBLE)) AS BIGINT) = w.lon_cell AND d.hour_bucket = w.hour_bucket"""


@case("ag_25_weather_coverage", sql.over(f"""
SELECT count(weather_severity) AS matched, count(*) AS total,
  {dec("count(weather_severity) * CAST(100 AS DOUBLE) / greatest(count(*), 1)", 1)} AS matched_pct,
  count(*) FILTER (WHERE weather_severity > 0) AS nonzero FROM matched_rows""", matched_rows=MATCHED))
def _(t):
    return weather.coverage(weather.with_weather(t.density, t.weather))


@case("ag_26_occupied_cells", sql.over(
    f"SELECT DISTINCT {sql.floored('lat')} AS lat_bin, {sql.floored('lon')} AS lon_bin FROM silver"))
def _(t):
    return weather.occupied_cells(t.silver)


@case("ag_26b_date_span", sql.over(
    "SELECT CAST(min(base_datetime) AS DATE) AS first_day, CAST(max(base_datetime) AS DATE) AS last_day FROM silver"))
def _(t):
    return weather.date_span(t.silver)


@case("ag_27_profile", sql.over("SELECT count(*) AS total_rows, count(DISTINCT mmsi) AS total_vessels FROM ais"))
def _(t):
    return analytics.profile(t.reports)


@case("ag_28_region_totals_lanes", sql.over(
    "SELECT us_region, CAST(sum(total_vessels) AS BIGINT) AS total_vessels FROM lanes GROUP BY 1",
    lanes=_lanes(_BY_MEANING, _DAYS)))
def _(t):
    return analytics.region_totals(analytics.busiest_lanes(t.density), "total_vessels")


@case("ag_28b_region_hour_means", sql.over(f"""
SELECT hour_of_day, us_region, {dec(avg("avg_vessels_per_cell", 6), 6)} AS avg_vessels_per_cell FROM hours GROUP BY 1, 2""",
                                           hours=_HOURS_FULL))
def _(t):
    return analytics.region_totals(
        analytics.congestion_by_hour(t.density, t.as_of), "avg_vessels_per_cell", ("hour_of_day", "us_region"), mean=True)


@case("ag_28c_region_collisions", sql.over(
    "SELECT us_region, CAST(sum(collision_alerts) AS BIGINT) AS collision_alerts FROM stats GROUP BY 1", stats=COLLISIONS))
def _(t):
    return analytics.region_totals(analytics.collision_stats(t.alerts, t.as_of), "collision_alerts")


@case("ag_29_alert_counters", sql.over("SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (WHERE severity = '{s}') AS {s.lower()}" for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
    + ", count(*) FILTER (WHERE is_resolved) AS resolved FROM alerts"))
def _(t):
    return analytics.alert_counters(t.alerts)


@case("ag_30_fleet_counters", sql.over(f"""
SELECT count(*) AS total_vessels, count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk,
  count(*) FILTER (WHERE is_anomaly) AS anomalies, {dec(total("coalesce(sog, 0)") + " / count(*)", 1)} AS avg_speed_kn
FROM latest"""))
def _(t):
    return analytics.fleet_counters(t.latest)


@case("ag_30b_anomaly_counters", sql.over("""
SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'HIGH') AS high,
  count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, count(*) FILTER (WHERE alert_type = 'ML_ANOMALY') AS ml_detected
FROM alerts WHERE alert_type <> 'COLLISION_RISK'"""))
def _(t):
    return analytics.anomaly_counters(t.alerts)


@case("ag_30c_zone_counters", sql.over("""
SELECT count(*) FILTER (WHERE congestion_level = 'HIGH') AS high_zones,
  count(*) FILTER (WHERE congestion_level = 'MEDIUM') AS medium_zones FROM density"""))
def _(t):
    return analytics.zone_counters(t.density)


@case("ag_31_rule_shares", sql.over(f"""
SELECT rule_type, count(*) AS count, {dec("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", 6)} AS share FROM (
  SELECT CASE WHEN time_delta_sec > 300 THEN 'AIS_GAP' WHEN sog > 30 THEN 'UNUSUAL_SPEED'
    WHEN heading_change > 45 AND sog > 2 THEN 'SHARP_TURN' WHEN sog_change < -5 THEN 'SUDDEN_STOP' ELSE '' END AS rule_type
  FROM silver) GROUP BY 1"""))
def _(t):
    return analytics.share(alerts.rule_labels(t.silver), "rule_type")


@case("ag_31b_level_shares", sql.over(f"""
SELECT congestion_level, count(*) AS count, {dec("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", 6)} AS share
FROM training GROUP BY 1""", training=TRAINING))
def _(t):
    return analytics.share(density_ops.training_density(t.silver, LOWERED), "congestion_level")
