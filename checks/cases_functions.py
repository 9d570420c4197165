"""FN-*: scalar functions, each over all position reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.registry import case
from checks.sql import dec
from wakeline import config as C
from wakeline.functions import cells, cleaning, geo, labels

# A partner position derived from each report, so that two-point formulas get non-trivial input.
LAT2 = "lat + (event_id % 13 - 6) / 40"
LON2 = "lon + (event_id % 17 - 8) / 40"
LAT2_SPARK = "(lat + (event_id % 13 - 6) / 40D)"
LON2_SPARK = "(lon + (event_id % 17 - 8) / 40D)"
LAT2_SQL = "(lat + (event_id % 13 - 6) / CAST(40 AS DOUBLE))"
LON2_SQL = "(lon + (event_id % 17 - 8) / CAST(40 AS DOUBLE))"


@case("fn_01_haversine", sql.over(
    f"SELECT event_id, {dec(sql.haversine('lat', 'lon', LAT2_SQL, LON2_SQL), 6)} AS nm FROM ais"))
def _(t):
    d = geo.haversine_nm("lat", "lon", LAT2_SPARK, LON2_SPARK)
    return t.reports.select("event_id", F.round(d, 6).alias("nm"))


_TERM = sql.half_chord("lat", "lon", LAT2_SQL, LON2_SQL)


@case("fn_02_haversine_atan2", sql.over(
    f"SELECT event_id, {dec(f'CAST({2 * sql.R!r} AS DOUBLE) * atan2(sqrt({_TERM}), sqrt(1 - {_TERM}))', 6)} AS nm "
    "FROM ais"))
def _(t):
    d = geo.haversine_atan2_nm("lat", "lon", LAT2_SPARK, LON2_SPARK)
    return t.reports.select("event_id", F.round(d, 6).alias("nm"))


@case("fn_03_bearing", sql.over(
    f"SELECT event_id, {dec(sql.bearing('lat', 'lon', LAT2_SQL, LON2_SQL), 6)} AS deg FROM ais"))
def _(t):
    return t.reports.select("event_id", F.round(geo.bearing_deg("lat", "lon", LAT2_SPARK, LON2_SPARK), 6).alias("deg"))


def _reckoned(minutes: int, guard: str, digits: int) -> str:
    miles = f"sog * ({minutes} / CAST(60 AS DOUBLE))"
    return (
        f"{dec(f'lat + {miles} * cos(radians(heading)) / 60', digits)} AS predicted_lat, "
        f"{dec(f'lon + {miles} * sin(radians(heading)) / (60 * cos(radians(lat)){guard})', digits)} AS predicted_lon"
    )


@case("fn_04_dead_reckoning", sql.over(
    f"SELECT event_id, {_reckoned(10, ' + CAST(0.000000001 AS DOUBLE)', 6)} FROM ais"))
def _(t):
    lat, lon = geo.dead_reckoning("lat", "lon", "sog", "heading", 10)
    return t.reports.select("event_id", lat.alias("predicted_lat"), lon.alias("predicted_lon"))


@case("fn_05_dead_reckoning_display", sql.over(
    f"SELECT event_id, CASE WHEN sog >= 0.1 THEN predicted_lat END AS predicted_lat, "
    f"CASE WHEN sog >= 0.1 THEN predicted_lon END AS predicted_lon "
    f"FROM (SELECT event_id, sog, {_reckoned(5, '', 6)} FROM ais)"))
def _(t):
    lat, lon = geo.dead_reckoning_display("lat", "lon", "sog", "heading", 5)
    return t.reports.select("event_id", F.round(lat, 6).alias("predicted_lat"), F.round(lon, 6).alias("predicted_lon"))


_H = "(heading - cog)"


@case("fn_06_turn_wrapped", sql.over(
    f"SELECT event_id, CASE WHEN abs{_H} > 180 THEN 360 - abs{_H} ELSE abs{_H} END AS turn FROM ais"))
def _(t):
    return t.reports.select("event_id", geo.turn_wrapped("heading", "cog").alias("turn"))


@case("fn_07_turn_signed", sql.over(
    f"SELECT event_id, CASE WHEN {_H} > 180 THEN {_H} - 360 WHEN {_H} < -180 THEN {_H} + 360 ELSE {_H} END AS turn "
    "FROM ais"))
def _(t):
    return t.reports.select("event_id", geo.turn_signed("heading", "cog").alias("turn"))


@case("fn_08_turn_modulo", sql.over(
    f"SELECT event_id, abs(fmod(fmod({_H} + 180, 360) + 360, 360) - 180) AS turn FROM ais"))
def _(t):
    return t.reports.select("event_id", geo.turn_modulo("heading - cog").alias("turn"))


@case("fn_09_cell_nearest", sql.over(
    f"SELECT event_id, {sql.nearest('lat')} AS lat_bin, {sql.nearest('lon')} AS lon_bin, {dec('lat', 1)} AS lat_tenth "
    "FROM ais"))
def _(t):
    return t.reports.select(
        "event_id", cells.coordinate("lat", digits=1).alias("lat_bin"),
        cells.coordinate("lon", digits=1).alias("lon_bin"), F.round("lat", 1).alias("lat_tenth"),
    )


@case("fn_10_cell_truncated", sql.over(
    "SELECT event_id, " + ", ".join(
        f"{sql.truncated(c, w)} AS {c}_{n}" for c in ("lat", "lon")
        for w, n in (("0.1", "tenth"), ("0.01", "hundredth"), ("0.5", "half"))) + " FROM ais"))
def _(t):
    widths = ((0.1, "tenth"), (0.01, "hundredth"), (0.5, "half"))
    return t.reports.select("event_id", *[
        cells.coordinate(c, w, "truncated").alias(f"{c}_{n}") for c in ("lat", "lon") for w, n in widths
    ])


@case("fn_11_cell_floor", sql.over(
    f"SELECT event_id, {sql.floored('lat')} AS lat_bin, {sql.floored('lon')} AS lon_bin FROM ais"))
def _(t):
    return t.reports.select("event_id", *[
        cells.coordinate(c, 0.5, "floor", 1).alias(f"{c}_bin") for c in ("lat", "lon")
    ])


@case("fn_12_cell_half_even", sql.over(
    f"SELECT event_id, {sql.half_even('lat')} AS lat_bin, {sql.half_even('lon')} AS lon_bin FROM ais"))
def _(t):
    return t.reports.select("event_id", *[
        cells.coordinate(c, 0.1, "half_even", 1).alias(f"{c}_bin") for c in ("lat", "lon")
    ])


@case("fn_13_cell_fine", sql.over(
    f"SELECT event_id, {dec('lat', 2)} AS lat_bin_fine, {dec('lon', 2)} AS lon_bin_fine FROM ais"))
def _(t):
    return t.reports.select("event_id", cells.fine("lat").alias("lat_bin_fine"), cells.fine("lon").alias("lon_bin_fine"))


# Spoiled spellings of the mmsi, derived from the report.
_MMSI_FORMS = ("CASE event_id % 5 WHEN 0 THEN mmsi || '.0' WHEN 1 THEN ' ' || mmsi || ' ' WHEN 2 THEN '3.6E+08' "
               "WHEN 3 THEN 'unknown' ELSE mmsi END")


@case("fn_14_repair_mmsi", sql.over(
    f"SELECT event_id, coalesce(CAST(CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS BIGINT) AS VARCHAR), trim(raw)) "
    f"AS mmsi FROM (SELECT event_id, {_MMSI_FORMS} AS raw FROM ais)"))
def _(t):
    return t.reports.selectExpr("event_id", f"{_MMSI_FORMS} AS raw").select(
        "event_id", cleaning.repair_mmsi("raw").alias("mmsi"))


_NUMBER_FORMS = ("CASE event_id % 6 WHEN 0 THEN 'nan' WHEN 1 THEN 'Infinity' WHEN 2 THEN 'x' WHEN 3 THEN NULL "
                 "ELSE CAST(event_id % 1000 AS {s}) || '.5' END")


@case("fn_15_safe_number", sql.over(
    "SELECT event_id, coalesce(CASE WHEN isfinite(n) THEN n END, 0) AS number FROM (SELECT event_id, "
    f"TRY_CAST({_NUMBER_FORMS.format(s='VARCHAR')} AS DOUBLE) AS n FROM ais)"))
def _(t):
    return t.reports.selectExpr("event_id", f"{_NUMBER_FORMS.format(s='STRING')} AS raw").select(
        "event_id", cleaning.safe_number("raw").alias("number"))


# Codes derived from the report, so that every label table meets known, unknown and missing codes.
_CODE_SPARK = "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'abc' ELSE CAST(event_id % 95 AS STRING) END"
_CODE_SQL = _CODE_SPARK.replace("STRING", "VARCHAR")
_FLOAT_SPARK = _CODE_SPARK.replace("CAST(event_id % 95 AS STRING)", "CAST(event_id % 95 AS STRING) || '.0'")
_FLOAT_SQL = _FLOAT_SPARK.replace("STRING", "VARCHAR")


def _numeric(table: dict) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in table.items())
    return f"(CASE TRY_CAST(code AS INTEGER) {arms} ELSE 'Unknown' END)"


_RANGES = ("CASE WHEN code IS NULL THEN 'Unknown Vessel Type' WHEN TRY_CAST(code AS DOUBLE) IS NULL THEN code "
           "WHEN CAST(code AS INTEGER) BETWEEN 70 AND 79 THEN 'Cargo' "
           "WHEN CAST(code AS INTEGER) BETWEEN 80 AND 89 THEN 'Tanker' "
           "WHEN CAST(code AS INTEGER) BETWEEN 60 AND 69 THEN 'Passenger' WHEN code = '30' THEN 'Fishing' "
           "WHEN code IN ('31', '32', '52') THEN 'Towing / Tug' WHEN code = '35' THEN 'Military' "
           "WHEN code = '36' THEN 'Sailing' WHEN code = '37' THEN 'Pleasure Craft' ELSE 'Unknown Vessel Type' END")


@case("fn_16_vessel_type_labels", sql.over(f"""
SELECT event_id, {sql.labelled("code", C.VESSEL_TYPES_CLEANED, "code")} AS cleaned,
  {sql.labelled("code", C.VESSEL_TYPES_SHARED, "'Type ' || code")} AS shared,
  CASE WHEN code IS NULL THEN '' ELSE {sql.labelled("code", C.VESSEL_TYPES_TRACK, "code")} END AS track,
  {_numeric(C.VESSEL_TYPES_NUMERIC)} AS numeric_form, {_RANGES} AS ranges,
  coalesce({sql.labelled("replace(float_code, '.0', '')", C.VESSEL_TYPES_SCREEN, "float_code")}, 'Unknown') AS screen
FROM (SELECT event_id, {_CODE_SQL} AS code, {_FLOAT_SQL} AS float_code FROM ais)"""))
def _(t):
    coded = t.reports.selectExpr("event_id", f"{_CODE_SPARK} AS code", f"{_FLOAT_SPARK} AS float_code")
    return coded.select(
        "event_id", labels.vessel_type_cleaned("code").alias("cleaned"),
        labels.vessel_type_shared("code").alias("shared"), labels.vessel_type_track("code").alias("track"),
        labels.vessel_type_numeric("code").alias("numeric_form"), labels.vessel_type_ranges("code").alias("ranges"),
        labels.vessel_type_screen("float_code").alias("screen"),
    )


_STATUS = "CAST(event_id % 17 AS {s})"


@case("fn_17_status_labels", sql.over(f"""
SELECT event_id, {sql.labelled("code", C.STATUS_CLEANED, "code")} AS cleaned,
  {sql.labelled("code", C.STATUS_SHARED, "'Status ' || code")} AS shared,
  {_numeric(C.STATUS_NUMERIC)} AS numeric_form
FROM (SELECT event_id, {_STATUS.format(s="VARCHAR")} AS code FROM ais)"""))
def _(t):
    return t.reports.selectExpr("event_id", f"{_STATUS.format(s='STRING')} AS code").select(
        "event_id", labels.status_cleaned("code").alias("cleaned"), labels.status_shared("code").alias("shared"),
        labels.status_numeric("code").alias("numeric_form"),
    )


_WIND = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 300 AS DOUBLE) / 10 END"
_WAVE = "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 70 AS DOUBLE) / 10 END"


@case("fn_18_weather_severity", sql.over(
    f"SELECT event_id, {dec(sql.weather_severity('wind', 'wave'), 6)} AS severity "
    f"FROM (SELECT event_id, {_WIND} AS wind, {_WAVE} AS wave FROM ais)"))
def _(t):
    return t.reports.selectExpr("event_id", f"{_WIND} AS wind", f"{_WAVE} AS wave").select(
        "event_id", F.round(labels.weather_severity("wind", "wave"), 6).alias("severity"))


@case("fn_19_congestion_level", sql.over(
    f"SELECT event_id, {sql.level('n')} AS level, {sql.level('n', 10, 3)} AS lowered "
    "FROM (SELECT event_id, event_id % 20 AS n FROM ais)"))
def _(t):
    return t.reports.selectExpr("event_id", "event_id % 20 AS n").select(
        "event_id", labels.congestion_level("n").alias("level"), labels.congestion_level("n", 10, 3).alias("lowered"))


@case("fn_20_alert_severity", sql.over(
    f"SELECT event_id, {sql.severity('anomaly_score')} AS severity FROM scored"))
def _(t):
    return t.scored.select("event_id", labels.alert_severity("anomaly_score").alias("severity"))


@case("fn_21_alert_texts", sql.over("SELECT id, description FROM alerts"))
def _(t):
    return t.alerts.select("id", "description")


_ISO_FORMS = ("CASE event_id % 4 WHEN 0 THEN replace({x}, ' ', 'T') || 'Z' WHEN 1 THEN {x} || '+02:00' "
              "WHEN 2 THEN 'not a time' ELSE {x} END")


@case("fn_22_iso_time", sql.over(
    "SELECT event_id, CASE WHEN event_id % 4 <> 2 THEN base_datetime END AS at FROM ais"))
def _(t):
    form = _ISO_FORMS.format(x="date_format(base_datetime, 'yyyy-MM-dd HH:mm:ss')")
    return t.reports.selectExpr("event_id", f"{form} AS raw").select("event_id", cleaning.iso_time("raw").alias("at"))


@case("fn_23_cut_text", sql.over(
    "SELECT event_id, substring(coalesce(vessel_name, ''), 1, 8) AS name, substring(coalesce(imo, 'LOW'), 1, 5) AS code "
    "FROM ais"))
def _(t):
    return t.reports.select(
        "event_id", cleaning.cut("vessel_name", 8).alias("name"), cleaning.cut("imo", 5, "LOW").alias("code"))


@case("fn_24_calendar", sql.over("""
SELECT event_id, CAST(hour(base_datetime) AS INTEGER) AS hour, CAST(isodow(base_datetime) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(base_datetime) >= 6 AS INTEGER) AS is_weekend, CAST(month(base_datetime) AS INTEGER) AS month FROM ais"""))
def _(t):
    return t.reports.selectExpr(
        "event_id", "hour(base_datetime) AS hour", "weekday(base_datetime) AS day_of_week",
        "CAST(weekday(base_datetime) >= 5 AS INT) AS is_weekend", "month(base_datetime) AS month")


@case("fn_25_truncate_time", sql.over(
    "SELECT event_id, " + ", ".join(
        f"CAST(date_trunc('{u}', base_datetime) AS TIMESTAMP) AS by_{u}" for u in ("minute", "hour", "day", "week"))
    + " FROM ais"))
def _(t):
    return t.reports.select("event_id", *[
        cleaning.truncate_time(u, "base_datetime").alias(f"by_{u}") for u in ("minute", "hour", "day", "week")
    ])
