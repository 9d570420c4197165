"""JN-*, SL-*, SET-*: joins, ordered limits, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.cases_aggregates import MATCHED, RISKY, ZONES
from checks.cases_windows import PEAKS
from checks.registry import case
from checks.sql import AS_OF, dec
from wakeline import config as C
from wakeline.operators import density as density_ops
from wakeline.operators import merge, proximity, zones
from wakeline.plans import analytics, queries, weather

_NEAR = "mmsi_1, mmsi_2, vessel_name_1, vessel_name_2, severity, converging, lat, lon, detected_at"


@case("jn_01_near_misses", sql.over(
    f"SELECT {_NEAR}, 'COLLISION_RISK' AS alert_type, {dec('dist', 3)} AS distance_nm FROM near_misses"))
def _(t):
    return t.near_misses.select(*_NEAR.split(", "), "alert_type", "distance_nm")


@case("jn_02_converging", sql.over(
    "SELECT severity, converging, count(*) AS pairs FROM near_misses GROUP BY 1, 2"))
def _(t):
    return t.near_misses.groupBy("severity", "converging").agg(F.count("*").alias("pairs"))


_POS = "SELECT DISTINCT lat, lon FROM clean"


@case("jn_01b_position_pairs", sql.over(f"""
SELECT a.lat AS lat_a, a.lon AS lon_a, b.lat AS lat_b, b.lon AS lon_b FROM spots a JOIN spots b
  ON (a.lat < b.lat OR (a.lat = b.lat AND a.lon < b.lon)) AND b.lat - a.lat < 0.0017
WHERE {sql.haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} < CAST(0.1 AS DOUBLE)""", spots=_POS))
def _(t):
    return proximity.position_pairs(t.clean.select("lat", "lon").distinct(), 0.1)


@case("jn_03_density_weather", sql.over("SELECT * FROM matched_rows", matched_rows=MATCHED))
def _(t):
    return weather.with_weather(t.density, t.weather)


@case("jn_03b_density_weather_exact", sql.over("""
SELECT d.*, w.weather_severity FROM density d LEFT JOIN weather w ON round(d.lat_bin * 10) = round(w.lat_bin * 10)
  AND round(d.lon_bin * 10) = round(w.lon_bin * 10) AND d.hour_bucket = w.hour_bucket"""))
def _(t):
    return weather.with_weather_exact(t.density, t.weather)


@case("jn_04_top_risky_vessels", sql.over("""
SELECT t.*, v.vessel_name, v.vessel_type_label, v.length, v.draft, f.lat AS last_lat, f.lon AS last_lon, f.sog AS last_sog
FROM (SELECT * FROM risky JOIN zones USING (mmsi) ORDER BY risk_count DESC, mmsi LIMIT 25) t
JOIN dim_vessel v USING (mmsi) JOIN latest f USING (mmsi)""", risky=RISKY, zones=ZONES))
def _(t):
    return analytics.top_risky_vessels(t.silver, t.dim_vessel, t.latest, t.as_of)


_ZONE = "CASE " + " ".join(
    f"WHEN lat BETWEEN {z.lat_min} AND {z.lat_max} AND lon BETWEEN {z.lon_min} AND {z.lon_max} THEN '{z.name}'"
    for z in C.PORT_BOXES) + " END"


@case("jn_05_port_zone", sql.over(f"SELECT event_id, base_datetime, {_ZONE} AS zone FROM ais"))
def _(t):
    return zones.with_zone(t.reports.select("event_id", "base_datetime", "lat", "lon")).select(
        "event_id", "base_datetime", "zone")


@case("jn_06_vessel_card", sql.over("""
SELECT l.*, d.imo, d.call_sign, d.length, d.width, d.draft, d.cargo, d.total_records, d.first_seen
FROM latest l LEFT JOIN (SELECT * FROM dim_vessel WHERE mmsi <> '360000003') d USING (mmsi)"""))
def _(t):
    return queries.vessel_card(t.latest, t.dim_vessel.filter("mmsi <> '360000003'"))


@case("jn_07_named_track", sql.over("""
SELECT s.event_id, s.mmsi, s.base_datetime, coalesce(nullif(l.vessel_name, ''), s.mmsi) AS display_name
FROM silver s LEFT JOIN (SELECT mmsi, CASE WHEN event_id % 3 <> 0 THEN vessel_name END AS vessel_name FROM newest
  WHERE event_id % 2 = 0) l USING (mmsi)"""))
def _(t):
    names = t.newest.filter("event_id % 2 = 0").withColumn(
        "vessel_name", F.expr("CASE WHEN event_id % 3 <> 0 THEN vessel_name END"))
    return queries.named_track(t.silver, names).select("event_id", "mmsi", "base_datetime", "display_name")


@case("jn_09_upsert_match", sql.over("""
SELECT coalesce(o.mmsi, n.mmsi) AS mmsi,
  CASE WHEN o.mmsi IS NULL THEN n.vessel_name ELSE o.vessel_name END AS vessel_name,
  CASE WHEN n.mmsi IS NULL THEN o.lat ELSE n.lat END AS lat, coalesce(o.hits, 0) + coalesce(n.hits, 0) AS hits
FROM (SELECT mmsi, vessel_name, lat, 1 AS hits FROM newest WHERE event_id % 3 <> 0) o
FULL JOIN (SELECT mmsi, upper(mmsi) || 'X' AS vessel_name, lat + 1 AS lat, 2 AS hits FROM newest WHERE event_id % 2 = 0) n
  ON o.mmsi = n.mmsi"""))
def _(t):
    old = t.newest.filter("event_id % 3 <> 0").selectExpr("mmsi", "vessel_name", "lat", "1 AS hits")
    new = t.newest.filter("event_id % 2 = 0").selectExpr("mmsi", "concat(mmsi, 'X') AS vessel_name", "lat + 1 AS lat", "2 AS hits")
    return merge.upsert(old, new, ("mmsi",), keep=("vessel_name",), on_match={"hits": F.expr("old.hits + fresh.hits")})


@case("sl_01_top_cells", sql.over(
    "SELECT * FROM density ORDER BY vessel_count DESC, lat_bin, lon_bin, hour_bucket, data_split LIMIT 100"))
def _(t):
    return t.density.orderBy(F.desc("vessel_count"), "lat_bin", "lon_bin", "hour_bucket", "data_split").limit(100)


@case("sl_02_mixed_order", sql.over(f"""
SELECT id, severity, created_at FROM alerts WHERE created_at >= {AS_OF} - INTERVAL 72 HOUR AND alert_type = 'COLLISION_RISK'
  AND NOT is_resolved ORDER BY severity DESC, created_at DESC, id LIMIT 20"""))
def _(t):
    return queries.open_collisions(t.alerts, t.as_of, 72, lexical=True).limit(20).select("id", "severity", "created_at")


_QUOTA = {"HIGH": 20, "MEDIUM": 10, "LOW": 100}
_RELABEL = sql.level("vessel_count", 4, 2)
_BALANCED = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY congestion_level ORDER BY vessel_count DESC, lat_bin, lon_bin) AS rn
  FROM (SELECT * REPLACE ({_RELABEL} AS congestion_level) FROM peaks))
WHERE (congestion_level = 'HIGH' AND rn <= 20) OR (congestion_level = 'MEDIUM' AND rn <= 10) OR (congestion_level = 'LOW' AND rn <= 100)"""


def _relabelled_peaks(t):
    from wakeline.functions import labels

    return density_ops.peak_hours(t.density).withColumn("congestion_level", labels.congestion_level("vessel_count", 4, 2))


@case("sl_03_quota_per_level", sql.over(_BALANCED, peaks=PEAKS))
def _(t):
    return queries.balanced_cells(_relabelled_peaks(t), _QUOTA)


@case("set_01_union_of_limits", sql.over(_BALANCED, peaks=PEAKS))
def _(t):
    return queries.balanced_cells_union(_relabelled_peaks(t), _QUOTA)


@case("set_02_concatenate", sql.over("""
SELECT event_id, mmsi, lat, CAST(NULL AS DOUBLE) AS lon FROM gated UNION ALL
SELECT event_id, mmsi, CAST(NULL AS DOUBLE), lon FROM clean"""))
def _(t):
    from wakeline.plans import bronze

    upper = bronze.batch_gate(t.reports).select("event_id", "mmsi", "lat")
    return upper.unionByName(t.clean.select("event_id", "mmsi", "lon"), allowMissingColumns=True)


@case("set_03_distinct_vessels", sql.over("SELECT DISTINCT mmsi, vessel_type FROM ais"))
def _(t):
    return t.reports.select("mmsi", "vessel_type").distinct()


def _map(source: str, fallback: str) -> str:
    return f"""
SELECT lat_bin AS lat, lon_bin AS lon, vessel_count, avg_sog, congestion_level,
  least(CAST(vessel_count AS DOUBLE) / max(vessel_count) OVER (), 1) AS weight, {fallback} AS is_historical_fallback
FROM (SELECT *, row_number() OVER (PARTITION BY congestion_level ORDER BY vessel_count DESC, lat_bin, lon_bin) AS q FROM (
  SELECT *, row_number() OVER (PARTITION BY lat_bin, lon_bin ORDER BY vessel_count DESC, hour_bucket, data_split) AS rn
  FROM {source}) WHERE rn = 1)
WHERE (congestion_level = 'HIGH' AND q <= 700) OR (congestion_level = 'MEDIUM' AND q <= 200) OR (congestion_level = 'LOW' AND q <= 100)"""


@case("set_04_fallback_recent", sql.over(_map(
    f"(SELECT * FROM density WHERE hour_bucket >= {AS_OF} - INTERVAL 240 HOUR)", "false")))
def _(t):
    return queries.density_map(t.density, t.silver, t.as_of, hours=240)


@case("set_04b_fallback_all", sql.over(_map("density", "true")))
def _(t):
    return queries.density_map(t.density, t.silver, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
