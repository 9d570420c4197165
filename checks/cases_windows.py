"""WN-*: per-vessel and per-cell series."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.cases_aggregates import LOWERED, TRAINING
from checks.registry import case
from checks.sql import dec
from wakeline.functions import geo
from wakeline.operators import density as density_ops
from wakeline.operators import timesplit, tracks
from wakeline.plans import alerts, analytics, silver

KEYS = "event_id, mmsi, base_datetime"


def _clean(t, *columns):
    """Clean reports with the columns of a query: rows and day summary share an exchange of these."""
    return t.clean.select(*KEYS.split(", "), *columns)


@case("wn_01_previous_position", sql.over(
    f"SELECT {KEYS}, prev_time, prev_lat, prev_lon, time_delta_sec, distance_nm FROM ({sql.stepped('clean')})"))
def _(t):
    linked = tracks.with_neighbour(_clean(t, "lat", "lon"), ("base_datetime", "lat", "lon"))
    return linked.select(
        "event_id", "mmsi", "base_datetime", F.col("prev.base_datetime").alias("prev_time"),
        F.col("prev.lat").alias("prev_lat"), F.col("prev.lon").alias("prev_lon"),
        silver.step_seconds("prev").alias("time_delta_sec"), silver.step_distance("prev").alias("distance_nm"),
    )


def _linked(t):
    return tracks.link_plausible(_clean(t, "lat", "lon", "sog", "heading"), silver.MOTION_FIELDS, silver.no_teleport)


@case("wn_02_teleport_filter", sql.over(f"SELECT {KEYS}, lat, lon FROM ({sql.survivors('clean')})"))
def _(t):
    return _linked(t).select("event_id", "mmsi", "base_datetime", "lat", "lon")


_MOTION = "sog_change, heading_change, time_delta_sec, distance_nm, lat_bin_fine, lon_bin_fine"


@case("wn_03_motion_features", sql.over(
    f"SELECT {KEYS}, {_MOTION}, {sql.nearest('lat')} AS lat_bin, {sql.nearest('lon')} AS lon_bin "
    f"FROM ({sql.features('survived')})", survived=sql.survivors("clean")))
def _(t):
    return silver.motion_features(_linked(t)).select(*KEYS.split(", "), *_MOTION.split(", "), "lat_bin", "lon_bin")


@case("wn_04_drop_first_pings", sql.over(
    f"SELECT {KEYS} FROM ({sql.features('survived')}) WHERE time_delta_sec IS NOT NULL AND distance_nm IS NOT NULL",
    survived=sql.survivors("clean")))
def _(t):
    return silver.motion_features(_linked(t)).dropna(subset=["time_delta_sec", "distance_nm"]).select(*KEYS.split(", "))


def _first(c):
    return (f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY mmsi ORDER BY base_datetime "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}")


@case("wn_05_fill_first_known", sql.over(
    f"SELECT {KEYS}, {_first('vessel_name')}, {_first('vessel_type')}, {_first('imo')} FROM clean"))
def _(t):
    columns = ["vessel_name", "vessel_type", "imo"]
    return tracks.fill_first_known(_clean(t, *columns), columns)


_FILLED = ("vessel_name", "vessel_type", "imo", "call_sign", "length", "width", "draft")


@case("wn_06_forward_fill", sql.over(f"SELECT {KEYS}, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in _FILLED)
    + " FROM clean WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime ROWS UNBOUNDED PRECEDING)"))
def _(t):
    return tracks.forward_fill(_clean(t, *_FILLED), _FILLED)


@case("wn_07_latest_per_vessel", sql.over("SELECT * EXCLUDE (is_stopped, is_slow, is_speeding) FROM newest"))
def _(t):
    extra = ("is_stopped", "is_slow", "is_speeding", "hour")
    return tracks.latest_per_vessel(t.silver, ("base_datetime",)).drop(*extra)


@case("wn_08_dedup_exact", sql.over("SELECT * FROM placed_once"))
def _(t):
    from wakeline.plans import bronze

    return tracks.dedup_exact(t.reports.filter(bronze.valid_position()))


@case("wn_09_dedup_minute", sql.over("""
SELECT event_id, mmsi, base_datetime, lat, lon FROM (
  SELECT *, rank() OVER (PARTITION BY mmsi, date_trunc('minute', base_datetime) ORDER BY base_datetime) AS r FROM ais)
WHERE r = 1"""))
def _(t):
    return tracks.dedup_minute(t.reports).select("event_id", "mmsi", "base_datetime", "lat", "lon")


@case("wn_10_last_in_batch", sql.over("""
SELECT mmsi, event_id, base_datetime, lat, lon, sog FROM (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_datetime DESC, event_id DESC) AS r FROM ais) WHERE r = 1"""))
def _(t):
    return tracks.latest_per_vessel(t.reports).select("mmsi", "event_id", "base_datetime", "lat", "lon", "sog")


def _ahead(minutes: int, steps: int) -> str:
    return f"""
SELECT {KEYS}, {minutes} AS minutes, next_lat, next_lon, next_lat - lat AS delta_lat, next_lon - lon AS delta_lon FROM (
  SELECT *, lead(lat, {steps}) OVER w AS next_lat, lead(lon, {steps}) OVER w AS next_lon FROM silver
  WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime))
WHERE abs(next_lat - lat) < 1 AND abs(next_lon - lon) < 1"""


@case("wn_11_future_position", sql.over(" UNION ALL ".join(_ahead(m, n) for m, n in ((5, 10), (10, 21), (15, 32)))))
def _(t):
    return timesplit.future_positions(t.silver, (5, 10, 15)).select(
        *KEYS.split(", "), "minutes", "next_lat", "next_lon", "delta_lat", "delta_lon")


PEAKS = """
SELECT lat_bin, lon_bin, vessel_count, avg_sog, congestion_level FROM (
  SELECT *, row_number() OVER (PARTITION BY lat_bin, lon_bin ORDER BY vessel_count DESC, hour_bucket, data_split) AS rn
  FROM density) WHERE rn = 1"""


@case("wn_12_peak_hour", sql.over("SELECT * FROM peaks", peaks=PEAKS))
def _(t):
    return density_ops.peak_hours(t.density)


@case("wn_13_heat_weight", sql.over("""
SELECT lat_bin, lon_bin, hour_bucket, data_split, vessel_count,
  least(CAST(vessel_count AS DOUBLE) / max(vessel_count) OVER (), 1) AS weight FROM density"""))
def _(t):
    return density_ops.heat_weight(t.density).select(
        "lat_bin", "lon_bin", "hour_bucket", "data_split", "vessel_count", "weight")


_STEP = dec(sql.haversine("prev_lat", "prev_lon", "lat", "lon"), 6)


@case("wn_14_batch_motion", sql.over(f"""
SELECT {KEYS}, coalesce(sog - prev_sog, 0) AS sog_change,
  abs(fmod(fmod(coalesce(heading - prev_heading, 0) + 180, 360) + 360, 360) - 180) AS heading_change,
  CASE WHEN prev_lat IS NULL THEN CAST(0 AS DOUBLE) ELSE {_STEP} END AS distance_nm FROM ({sql.lagged('clean')})"""))
def _(t):
    moved = alerts.batch_motion(_clean(t, "lat", "lon", "sog", "heading"))
    return moved.select(*KEYS.split(", "), "sog_change", "heading_change", F.round("distance_nm", 6).alias("distance_nm"))


@case("wn_15_normalise_scores", sql.over(f"""
SELECT event_id, {dec("1 - (raw_score - lo) / (hi - lo + CAST(0.000000001 AS DOUBLE))", 6)} AS norm
FROM (SELECT event_id, -distance_nm - sog AS raw_score FROM silver),
  (SELECT min(-distance_nm - sog) AS lo, max(-distance_nm - sog) AS hi FROM silver)"""))
def _(t):
    scored = t.silver.selectExpr("event_id", "-distance_nm - sog AS raw_score")
    return alerts.normalise_scores(scored).select("event_id", F.round("norm", 6).alias("norm"))


@case("wn_16_next_hour_target", sql.over("""
SELECT a.lat_cell, a.lon_cell, a.hour_bucket, a.congestion_level, b.congestion_level AS future_congestion
FROM training a JOIN training b ON a.lat_cell = b.lat_cell AND a.lon_cell = b.lon_cell
  AND b.hour_bucket = a.hour_bucket + INTERVAL 1 HOUR""", training=TRAINING))
def _(t):
    cellhours = density_ops.training_density(t.silver, LOWERED)
    return timesplit.next_hour_target(cellhours).select(
        "lat_cell", "lon_cell", "hour_bucket", "congestion_level", "future_congestion")


def _split(source: str, time: str, columns: str) -> str:
    return f"""
SELECT {columns}, CASE WHEN {time} <= (SELECT min({time}) FROM (
    SELECT {time}, sum(count(*)) OVER (ORDER BY {time}) AS cum, sum(count(*)) OVER () AS n FROM {source} GROUP BY {time})
    WHERE cum >= n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM {source}"""


@case("wn_17_split_cellhours", sql.over(_split("training", "hour_bucket", "lat_cell, lon_cell, hour_bucket"), training=TRAINING))
def _(t):
    cellhours = density_ops.training_density(t.silver, LOWERED)
    return timesplit.split_by_time(cellhours, "hour_bucket").select("lat_cell", "lon_cell", "hour_bucket", "part")


@case("wn_18_split_reports", sql.over(_split("silver", "base_datetime", "event_id")))
def _(t):
    return timesplit.split_by_time(t.silver, "base_datetime").select("event_id", "part")


@case("wn_19_bearing_to_next", sql.over(f"""
SELECT {KEYS}, CASE WHEN next_lat IS NULL THEN coalesce(nullif(cog, 0), nullif(heading, 0), 0)
  ELSE {dec(sql.bearing("lat", "lon", "next_lat", "next_lon"), 6)} END AS bearing FROM (
  SELECT *, lead(lat) OVER w AS next_lat, lead(lon) OVER w AS next_lon FROM clean
  WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime))"""))
def _(t):
    linked = tracks.with_neighbour(_clean(t, "lat", "lon", "cog", "heading"), ("lat", "lon"), "next", ahead=True)
    on_track = F.round(geo.bearing_deg("lat", "lon", "next.lat", "next.lon"), 6)
    last = F.expr("coalesce(nullif(cog, 0D), nullif(heading, 0D), 0D)")
    return linked.select(*KEYS.split(", "), F.when(F.col("next").isNull(), last).otherwise(on_track).alias("bearing"))


@case("wn_20_zscore", sql.over("""
SELECT stat_date, value, z, coalesce(abs(z) > 1.5, false) AS is_outlier FROM (
  SELECT stat_date, value, CASE WHEN count(*) OVER w >= 4 AND stddev_pop(value) OVER w > 0.000000001 THEN
    CAST(round(CAST((value - avg(value) OVER w) / stddev_pop(value) OVER w AS DECIMAL(38,12)), 4) AS DOUBLE) END AS z
  FROM (SELECT stat_date, CAST(sum(total_records) AS DOUBLE) AS value FROM daily GROUP BY 1)
  WINDOW w AS (ORDER BY stat_date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))"""))
def _(t):
    per_day = t.daily.groupBy("stat_date").agg(F.sum("total_records").alias("rows"))
    return analytics.zscore(per_day, "rows", 1.5)


_SIGNED = "CASE WHEN h > 180 THEN h - 360 WHEN h < -180 THEN h + 360 ELSE h END"


@case("wn_21_signed_motion", sql.over(f"""
SELECT {KEYS}, sog - prev_sog AS sog_change, {_SIGNED} AS heading_change, {sql.SECONDS} AS time_delta_sec,
  {_STEP} AS distance_nm, {sql.truncated("lat", "0.01")} AS lat_bin_fine, {sql.truncated("lon", "0.01")} AS lon_bin_fine
FROM (SELECT *, heading - prev_heading AS h FROM ({sql.lagged('clean')}))"""))
def _(t):
    moved = silver.signed_motion(_clean(t, "lat", "lon", "sog", "heading"))
    return moved.select(
        *KEYS.split(", "), "sog_change", "heading_change", "time_delta_sec",
        F.round("distance_nm", 6).alias("distance_nm"), "lat_bin_fine", "lon_bin_fine")


