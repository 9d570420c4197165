"""DuckDB texts of the shared tables, written the plain way: whole-vessel windows, brute-force pairs."""

from __future__ import annotations

import re

from wakeline import config as C
from checks import testbed

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
R = C.EARTH_RADIUS_NM


def dec(expr: str, digits: int) -> str:
    """Rounding on the decimal form of a double, half away from zero."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def avg(expr: str, digits: int = 4) -> str:
    """Average over exact units of the last decimal."""
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    units = f"sum(CAST(round_even(({expr}) * {scale}, 0) AS BIGINT))"
    return f"(CAST({units} AS DOUBLE) / nullif(count({expr}) * {scale}, 0))"


def total(expr: str, digits: int = 4) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(CAST(sum(CAST(round_even(({expr}) * {scale}, 0) AS BIGINT)) AS DOUBLE) / {scale})"


def half_chord(lat1, lon1, lat2, lon2) -> str:
    n, e = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    return f"({n} * {n} + cos(radians({lat1})) * cos(radians({lat2})) * {e} * {e})"


def haversine(lat1, lon1, lat2, lon2) -> str:
    return f"(CAST({2 * R!r} AS DOUBLE) * asin(sqrt({half_chord(lat1, lon1, lat2, lon2)})))"


def bearing(lat1, lon1, lat2, lon2) -> str:
    dlon = f"radians({lon2} - {lon1})"
    y = f"sin({dlon}) * cos(radians({lat2}))"
    x = (f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) "
         f"* cos({dlon})")
    return f"fmod(degrees(atan2({y}, {x})) + 360, CAST(360 AS DOUBLE))"


def nearest(expr: str, width: str = "0.1", digits: int = 1) -> str:
    return f"round(round({expr} / CAST({width} AS DOUBLE)) * CAST({width} AS DOUBLE), {digits})"


def truncated(expr: str, width: str, digits: int = 2) -> str:
    return f"round(CAST(trunc({expr} / CAST({width} AS DOUBLE)) AS BIGINT) * CAST({width} AS DOUBLE), {digits})"


def floored(expr: str, width: str = "0.5", digits: int = 1) -> str:
    return f"round(floor({expr} / CAST({width} AS DOUBLE)) * CAST({width} AS DOUBLE), {digits})"


def half_even(expr: str, width: str = "0.1", digits: int = 1) -> str:
    return f"round(round_even({expr} / CAST({width} AS DOUBLE), 0) * CAST({width} AS DOUBLE), {digits})"


def boxes(lat: str, lon: str, zones=C.PORT_BOXES) -> str:
    return "(" + " OR ".join(
        f"({lat} BETWEEN {z.lat_min} AND {z.lat_max} AND {lon} BETWEEN {z.lon_min} AND {z.lon_max})" for z in zones
    ) + ")"


def labelled(code: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"(CASE {code} {arms} ELSE {default} END)"


def region(lat: str, lon: str, lakes: bool = True) -> str:
    last = f"WHEN {lon} BETWEEN -93 AND -76 AND {lat} BETWEEN 41 AND 49 THEN 'Great Lakes' " if lakes else ""
    return (f"(CASE WHEN {lon} BETWEEN -82 AND -66 THEN 'East Coast' "
            f"WHEN {lon} BETWEEN -125 AND -117 THEN 'West Coast' "
            f"WHEN {lon} BETWEEN -97 AND -80 AND {lat} BETWEEN 24 AND 31 THEN 'Gulf of Mexico' {last}"
            f"ELSE 'Other US Waters' END)")


def us(lat: str, lon: str) -> str:
    return f"({lat} BETWEEN 24 AND 49 AND {lon} BETWEEN -125 AND -66)"


def risk(sog: str = "sog", inside: str = "in_us_port_zone", stopped: str = "0.5") -> str:
    return f"(CASE WHEN {sog} < {stopped} AND {inside} THEN 'HIGH' WHEN {sog} < 2 THEN 'MEDIUM' ELSE 'LOW' END)"


def level(count: str, high: int = 15, medium: int = 5) -> str:
    return f"(CASE WHEN {count} >= {high} THEN 'HIGH' WHEN {count} >= {medium} THEN 'MEDIUM' ELSE 'LOW' END)"


def severity(score: str) -> str:
    return f"(CASE WHEN {score} >= 0.7 THEN 'HIGH' WHEN {score} >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END)"


def weather_severity(wind: str, wave: str) -> str:
    w = f"least(greatest({wind} / CAST(24.5 AS DOUBLE), 0), 1)"
    v = f"least(greatest({wave} / CAST(6 AS DOUBLE), 0), 1)"
    return (f"coalesce(CASE WHEN {wave} IS NULL THEN CASE WHEN {wind} IS NULL THEN NULL ELSE {w} END "
            f"WHEN {wind} IS NULL THEN NULL "
            f"ELSE CAST(0.6 AS DOUBLE) * {w} + CAST(0.4 AS DOUBLE) * {v} END, 0)")


GATE = ("mmsi <> '' AND lat <> 0 AND lon <> 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 "
        "AND sog BETWEEN 0 AND 60")
PLACED = "lat <> 0 AND lon <> 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
SECONDS = "CAST(epoch(base_datetime) - epoch(prev_time) AS BIGINT)"


def _validity(source: str) -> str:
    return f"""
SELECT * FROM (
  SELECT * REPLACE (CASE WHEN sog <> CAST(102.3 AS DOUBLE) THEN sog END AS sog,
                    CASE WHEN heading <> 511 THEN heading END AS heading) FROM {source})
WHERE (sog IS NULL OR sog BETWEEN 0 AND 60) AND (cog IS NULL OR (cog >= 0 AND cog < 360))
  AND (heading IS NULL OR (heading >= 0 AND heading < 360))
  AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"""


def _dedup(source: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, base_datetime "
            f"ORDER BY event_id) AS rn FROM {source}) WHERE rn = 1")


def lagged(source: str) -> str:
    """Previous row per vessel by a whole-vessel window."""
    return f"""
SELECT *, lag(base_datetime) OVER w AS prev_time, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon,
       lag(sog) OVER w AS prev_sog, lag(heading) OVER w AS prev_heading
FROM {source} WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime)"""


def stepped(source: str) -> str:
    dist = dec(haversine("prev_lat", "prev_lon", "lat", "lon"), 4)
    return f"SELECT *, {SECONDS} AS time_delta_sec, {dist} AS distance_nm FROM ({lagged(source)})"


IMPLIED = ("CASE WHEN prev_lat IS NULL THEN 0 WHEN time_delta_sec > 0 THEN distance_nm / (time_delta_sec / "
           "CAST(3600 AS DOUBLE)) WHEN distance_nm > 0 THEN 999999 ELSE 0 END")
LAGS = "prev_time, prev_lat, prev_lon, prev_sog, prev_heading"


def survivors(source: str) -> str:
    return f"SELECT * EXCLUDE ({LAGS}, time_delta_sec, distance_nm) FROM ({stepped(source)}) WHERE {IMPLIED} <= 100"


def features(source: str) -> str:
    return f"""
SELECT * EXCLUDE ({LAGS}), sog - prev_sog AS sog_change,
  CASE WHEN abs(heading - prev_heading) > 180 THEN 360 - abs(heading - prev_heading)
       ELSE abs(heading - prev_heading) END AS heading_change,
  {dec("lat", 2)} AS lat_bin_fine, {dec("lon", 2)} AS lon_bin_fine
FROM ({stepped(source)})"""


SPLIT = "CASE WHEN day(base_datetime) <= 5 THEN 'train' WHEN day(base_datetime) = 6 THEN 'test' ELSE 'live' END"


def _first_known(column: str) -> str:
    return (f"coalesce({column}, first_value({column} IGNORE NULLS) OVER (PARTITION BY mmsi ORDER BY base_datetime "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {column}")


def _scored() -> str:
    return f"""
SELECT *,
  CASE WHEN sog < 0.5 AND in_us_port_zone THEN 'STATIONARY_RISK'
       WHEN heading_change > 45 AND sog > 2 THEN 'SHARP_TURN'
       WHEN sog > 30 THEN 'UNUSUAL_SPEED'
       WHEN sog_change < -5 THEN 'SUDDEN_STOP' ELSE '' END AS anomaly_type,
  CASE WHEN sog < 0.5 AND in_us_port_zone THEN CAST(0.9 AS DOUBLE)
       WHEN heading_change > 45 AND sog > 2 THEN least(heading_change / 180, 1)
       WHEN sog > 30 THEN sog / 60
       WHEN sog_change < -5 THEN CAST(0.8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS anomaly_score,
  coalesce((sog < 0.5 AND in_us_port_zone) OR (heading_change > 45 AND sog > 2) OR sog > 30 OR sog_change < -5,
           false) AS is_anomaly
FROM silver"""


def near_miss_sql(source: str, seconds: int | None = None) -> str:
    """Every pair of positions, compared directly; at most so many seconds apart."""
    near = f" AND abs(date_diff('second', a.base_datetime, b.base_datetime)) <= {seconds}" if seconds else ""
    dist = haversine("a.lat", "a.lon", "b.lat", "b.lon")
    turn = f"abs(coalesce(a.heading, 0) - {bearing('a.lat', 'a.lon', 'b.lat', 'b.lon')})"
    return f"""
SELECT *, CASE WHEN dist < 0.05 THEN 'CRITICAL' WHEN converging THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM (
  SELECT a.mmsi AS mmsi_1, b.mmsi AS mmsi_2, a.vessel_name AS vessel_name_1, b.vessel_name AS vessel_name_2,
         a.event_id AS event_id_1, b.event_id AS event_id_2,
         {dist} AS dist, (CASE WHEN {turn} > 180 THEN 360 - {turn} ELSE {turn} END) < 45 AS converging,
         (a.lat + b.lat) / 2 AS lat, (a.lon + b.lon) / 2 AS lon,
         greatest(a.base_datetime, b.base_datetime) AS detected_at
  FROM {source} a JOIN {source} b ON a.mmsi < b.mmsi AND a.sog >= 1 AND b.sog >= 1{near}
) WHERE dist > 0 AND dist < CAST(0.1 AS DOUBLE)"""


def alert_id(kind: str, first: str, second: str, at: str) -> str:
    text = f"concat_ws('|', {kind}, {first}, {second}, strftime({at}, '%Y-%m-%d %H:%M:%S'))"
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_CTES: dict[str, str] = {
    "ais": testbed.duckdb_sql(),
    "gated": f"SELECT * FROM ais WHERE {GATE}",
    "placed": f"SELECT * FROM ais WHERE {PLACED}",
    "placed_once": _dedup("placed"),
    "clean": _validity("placed_once"),
    "bronze": f"""
SELECT *, {risk()} AS risk_level FROM (
  SELECT *, sog < 0.5 AS is_stopped, sog < 2 AS is_slow, sog > 30 AS is_speeding,
         {boxes("lat", "lon")} AS in_us_port_zone,
         {nearest("lat")} AS lat_bin, {nearest("lon")} AS lon_bin
  FROM gated)""",
    "bronze_once": _dedup("bronze"),
    "bronze_valid": _validity("bronze_once"),
    "filled": f"""
SELECT * REPLACE ({_first_known("vessel_name")}, {_first_known("vessel_type")}, {_first_known("imo")}),
  {labelled("vessel_type", C.VESSEL_TYPES_CLEANED, "vessel_type")} AS vessel_type_label,
  {labelled("status", C.STATUS_CLEANED, "status")} AS status_label
FROM bronze_valid""",
    "kept": survivors("filled"),
    "silver": f"""
SELECT *, {SPLIT} AS data_split, CAST(year(base_datetime) AS INTEGER) AS year,
  CAST(month(base_datetime) AS INTEGER) AS month, CAST(day(base_datetime) AS INTEGER) AS day
FROM ({features("kept")}) WHERE time_delta_sec IS NOT NULL AND distance_nm IS NOT NULL""",
    "newest": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_datetime DESC) AS rn
FROM silver) WHERE rn = 1""",
    "latest": """
SELECT mmsi, vessel_name, vessel_type, lat, lon, sog, cog, heading, risk_level, base_datetime, data_split,
  false AS is_anomaly, CAST(0 AS DOUBLE) AS anomaly_score, '' AS anomaly_type,
  CAST(NULL AS DOUBLE) AS predicted_lat, CAST(NULL AS DOUBLE) AS predicted_lon, base_datetime AS updated_at
FROM newest""",
    "density": f"""
SELECT *, {level("vessel_count")} AS congestion_level FROM (
  SELECT lat_bin, lon_bin, date_trunc('hour', base_datetime) AS hour_bucket, data_split,
    count(*) AS vessel_count, count(DISTINCT mmsi) AS unique_vessels, {avg("sog")} AS avg_sog,
    count(*) FILTER (WHERE sog < 0.5) AS stopped_count
  FROM silver GROUP BY 1, 2, 3, 4)""",
    "daily": f"""
SELECT CAST(base_datetime AS DATE) AS stat_date, data_split, count(DISTINCT mmsi) AS total_vessels,
  count(*) AS total_records, {dec(avg("sog"), 2)} AS avg_sog, {dec("max(sog)", 2)} AS max_sog,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count,
  count(*) FILTER (WHERE sog < 0.5) AS stopped_vessels, CAST(0 AS INTEGER) AS anomaly_count
FROM silver GROUP BY 1, 2""",
    "dim_vessel": """
SELECT mmsi, arg_max(vessel_name, base_datetime) FILTER (WHERE vessel_name IS NOT NULL) AS vessel_name,
  arg_max(imo, base_datetime) FILTER (WHERE imo IS NOT NULL) AS imo,
  arg_max(call_sign, base_datetime) FILTER (WHERE call_sign IS NOT NULL) AS call_sign,
  arg_max(vessel_type, base_datetime) FILTER (WHERE vessel_type IS NOT NULL) AS vessel_type,
  arg_max(vessel_type_label, base_datetime) FILTER (WHERE vessel_type_label IS NOT NULL) AS vessel_type_label,
  max(length) AS length, max(width) AS width, max(draft) AS draft,
  arg_max(cargo, base_datetime) FILTER (WHERE cargo IS NOT NULL) AS cargo,
  arg_max(transceiver_class, base_datetime) FILTER (WHERE transceiver_class IS NOT NULL) AS transceiver_class,
  arg_max(data_split, base_datetime) AS data_split,
  min(base_datetime) AS first_seen, max(base_datetime) AS last_seen, count(*) AS total_records
FROM silver GROUP BY mmsi""",
    "scored": _scored(),
    "near_misses": near_miss_sql("newest"),
    "alerts": f"""
SELECT {alert_id("anomaly_type", "mmsi", "''", "base_datetime")} AS id, anomaly_type AS alert_type, {severity("anomaly_score")} AS severity, mmsi AS mmsi_1,
  CAST(NULL AS VARCHAR) AS mmsi_2, vessel_name AS vessel_name_1, CAST(NULL AS VARCHAR) AS vessel_name_2, lat, lon,
  printf('%s detected for vessel %s — score %.2f', anomaly_type, mmsi, {dec("anomaly_score", 2)}) AS description,
  anomaly_score, CAST(NULL AS DOUBLE) AS distance_nm, {alert_id("anomaly_type", "mmsi", "''", "base_datetime")} % 4 = 0 AS is_resolved,
  base_datetime AS created_at, 'live' AS data_split
FROM scored WHERE is_anomaly
UNION ALL
SELECT {alert_id("'COLLISION_RISK'", "mmsi_1", "mmsi_2", "detected_at")}, 'COLLISION_RISK', severity, mmsi_1, mmsi_2, vessel_name_1, vessel_name_2,
  lat, lon, printf('Vessels %s and %s are %.2f nm apart', mmsi_1, mmsi_2, {dec("dist", 2)})
    || CASE WHEN converging THEN ' and converging' ELSE '' END,
  CAST(NULL AS DOUBLE), {dec("dist", 3)}, {alert_id("'COLLISION_RISK'", "mmsi_1", "mmsi_2", "detected_at")} % 4 = 0, detected_at, 'live'
FROM near_misses""",
    "weather_hours": f"""
SELECT lat_cell, lon_cell, hour_bucket,
  CAST(((abs(lat_cell) * 131 + abs(lon_cell)) * 7 + hour(hour_bucket)) % 300 AS DOUBLE) / 10 AS wind_speed_10m,
  CASE WHEN (abs(lat_cell) + abs(lon_cell)) % 3 = 0 THEN NULL
       ELSE CAST((abs(lat_cell) + hour(hour_bucket)) % 70 AS DOUBLE) / 10 END AS wave_height
FROM (SELECT DISTINCT CAST(floor(lat / CAST(0.5 AS DOUBLE)) AS BIGINT) AS lat_cell,
        CAST(floor(lon / CAST(0.5 AS DOUBLE)) AS BIGINT) AS lon_cell,
        date_trunc('hour', base_datetime) AS hour_bucket FROM silver)
WHERE (abs(lat_cell) + abs(lon_cell) + hour(hour_bucket)) % 5 <> 0""",
    "weather": f"""
SELECT lat_cell, lon_cell, CAST(lat_cell AS DOUBLE) * CAST(0.5 AS DOUBLE) AS lat_bin,
  CAST(lon_cell AS DOUBLE) * CAST(0.5 AS DOUBLE) AS lon_bin, hour_bucket, wind_speed_10m, wave_height,
  {dec(weather_severity("wind_speed_10m", "wave_height"), 6)} AS weather_severity
FROM (SELECT lat_cell, lon_cell, hour_bucket, {avg("wind_speed_10m")} AS wind_speed_10m,
        {avg("wave_height")} AS wave_height FROM weather_hours GROUP BY 1, 2, 3)""",
}


def _mentioned(text: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return {name for name in _CTES if name in words}


def over(final: str, **extra: str) -> str:
    """``final`` preceded by exactly the shared tables it needs, in order of definition."""
    order = list(_CTES)
    needed = _mentioned(final) | set().union(*[_mentioned(t) for t in extra.values()], set())
    frontier = set(needed)
    while frontier:
        name = frontier.pop()
        for dep in _mentioned(_CTES[name]) - {name}:
            if order.index(dep) < order.index(name) and dep not in needed:
                needed.add(dep)
                frontier.add(dep)
    parts = [f"{n} AS ({_CTES[n]})" for n in order if n in needed]
    parts += [f"{n} AS ({t})" for n, t in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()
