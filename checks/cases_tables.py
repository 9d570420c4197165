"""SRC-* and SNK-* on files and tables. Every write goes to a fresh folder below the shared checkpoint root."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks import sql, testbed
from checks.cases_projections import _INGESTED, _TEXT_SQL, REPORT_COLUMNS, text_reports, with_file
from checks.registry import case
from checks.sql import AS_OF
from wakeline.plans import alerts, warehouse, weather
from wakeline.session import scratch_dir
from wakeline.sinks import maintenance, tables
from wakeline.sources import files
from wakeline.streaming import scoring

_SHORT = "event_id, mmsi, base_datetime, lat, lon, sog"
SHORT = _SHORT.split(", ")
_OLD_HEADERS = {"mmsi": "MMSI", "base_datetime": "BaseDateTime", "lat": "LAT", "lon": "LON", "sog": "SOG", "cog": "COG",
                "heading": "Heading", "vessel_name": "VesselName", "call_sign": "CallSign"}
_NEW_HEADERS = {"base_datetime": "base_date_time", "lat": "latitude", "lon": "longitude", "vessel_type": "type"}


@case("src_01_read_day_files", sql.over(f"SELECT * FROM ({_INGESTED})", raw=_TEXT_SQL))
def _(t):
    text = text_reports(t)
    folder = scratch_dir(t.spark, "raw-days")
    # one folder with files of two spellings, and some with their columns the other way round
    text.filter("event_id % 2 = 1").withColumnsRenamed(_NEW_HEADERS).write.option("header", True).csv(folder)
    text.filter("event_id % 4 = 0").select(*reversed(text.columns)).write.option("header", True).mode("append").csv(folder)
    text.filter("event_id % 4 = 2").withColumnsRenamed(_OLD_HEADERS).write.option("header", True).mode("append").csv(folder)
    raw = files.read_days(t.spark, [folder]).drop("source_file")
    rows = files.with_ingest_columns(files.ingest(raw, blank_as_null=False))
    return rows.withColumn("event_id", F.col("event_id").cast("bigint"))


def _silver_path(t):
    path = scratch_dir(t.spark, "silver-parts")
    tables.write_partitioned(t.silver, path)
    return path


@case("src_02_scan_partitions", sql.over(f"SELECT {_SHORT} FROM silver WHERE day BETWEEN 10 AND 12 AND sog > 5"))
def _(t):
    return t.spark.read.parquet(_silver_path(t)).filter("day BETWEEN 10 AND 12 AND sog > 5").select(*SHORT)


@case("src_03_scan_table", sql.over(f"SELECT {_SHORT} FROM silver"))
def _(t):
    return t.silver.select(*SHORT)


@case("src_06_live_rows", sql.over(f"SELECT {_SHORT} FROM silver WHERE data_split = 'live' ORDER BY base_datetime, mmsi"))
def _(t):
    return files.live_rows(t.silver, "LIVE").select(*SHORT)


@case("src_07_capped_sample", sql.over("""
SELECT source_file, least(n, 2000 // files + CASE WHEN place <= 2000 % files THEN 1 ELSE 0 END) AS rows FROM (
  SELECT *, count(*) OVER () AS files, row_number() OVER (ORDER BY source_file) AS place FROM (
    SELECT 'ais-' || strftime(base_datetime, '%Y-%m-%d') || '.csv' AS source_file, count(*) AS n FROM silver
    WHERE data_split <> 'test' GROUP BY 1))"""))
def _(t):
    rows = with_file(t.silver.replace("live", "train", "data_split"))
    sample = files.capped_sample(rows, 2000)
    return sample.groupBy("source_file").agg(F.count("*").alias("rows"))


@case("src_07b_sampled_rows")
def _(t):
    return files.capped_sample(with_file(t.silver), 5000).select("source_file", *SHORT)


@case("src_08_weather_payload", sql.over("""
SELECT lat_cell, lon_cell, hour_bucket AS time, wind_speed_10m, wave_height FROM weather_hours"""))
def _(t):
    hours = testbed.weather(t.silver)
    series = hours.groupBy("lat_cell", "lon_cell").agg(
        F.array_sort(F.collect_list(F.struct("time", "wind_speed_10m", "wave_height"))).alias("h"))
    payload = series.select("lat_cell", "lon_cell", F.to_json(F.struct(F.struct(
        F.expr("transform(h, x -> date_format(x.time, \"yyyy-MM-dd'T'HH:mm\"))").alias("time"),
        F.col("h.wind_speed_10m").alias("wind_speed_10m"), F.col("h.wave_height").alias("wave_height"),
    ).alias("hourly"))).alias("payload"))
    return weather.parse_payload(payload)


def _control(t, at: str):
    return t.spark.createDataFrame([("density", at, 0, at)], "table_name string, last_loaded string, rows_loaded long, updated_at string").selectExpr(
        "table_name", "CAST(last_loaded AS TIMESTAMP_NTZ) AS last_loaded", "rows_loaded", "CAST(updated_at AS TIMESTAMP_NTZ) AS updated_at")


@case("src_09_newer_than", sql.over("SELECT * FROM density WHERE hour_bucket > TIMESTAMP '2024-01-15 12:00:00'"))
def _(t):
    return files.newer_than(t.density, "hour_bucket", _control(t, "2024-01-15 12:00:00"), "density")


@case("src_11_scan_columns", sql.over("SELECT lat, lon, base_datetime FROM silver"))
def _(t):
    return t.spark.read.parquet(_silver_path(t)).select("lat", "lon", "base_datetime")


@case("snk_01_write_partitioned", sql.over(
    "SELECT year, month, day, count(*) AS rows, min(base_datetime) AS first_at FROM silver GROUP BY 1, 2, 3"))
def _(t):
    stored = t.spark.read.parquet(_silver_path(t))
    return stored.groupBy("year", "month", "day").agg(F.count("*").alias("rows"), F.min("base_datetime").alias("first_at"))


@case("snk_02_overwrite_snapshot", sql.over("SELECT * FROM daily"))
def _(t):
    path = scratch_dir(t.spark, "snapshot")
    tables.overwrite_snapshot(t.density, path)
    tables.overwrite_snapshot(t.daily, path)  # another schema replaces the first one
    return t.spark.read.parquet(path)


@case("snk_03_overwrite_partitions", sql.over("""
SELECT event_id, day, CASE WHEN day = 6 THEN 0 ELSE sog END AS sog FROM silver WHERE day <> 6 OR event_id % 2 = 0"""))
def _(t):
    path = _silver_path(t)
    again = t.silver.filter("day = 6 AND event_id % 2 = 0").withColumn("sog", F.lit(0.0))
    tables.overwrite_partitions(again, path)
    return t.spark.read.parquet(path).select("event_id", "day", "sog")


@case("snk_04_append_evolving", sql.over("""
SELECT event_id, mmsi, sog, CAST(NULL AS DOUBLE) AS draft FROM silver WHERE day < 10
UNION ALL SELECT event_id, mmsi, CAST(NULL AS DOUBLE), draft FROM silver WHERE day >= 10"""))
def _(t):
    path = scratch_dir(t.spark, "evolving")
    tables.append_evolving(t.silver.filter("day < 10").select("event_id", "mmsi", "sog"), path)
    tables.append_evolving(t.silver.filter("day >= 10").select("event_id", "mmsi", "draft"), path)
    return tables.read_evolving(t.spark, path)


def _live_half(t, half: str):
    rows = alerts.predict_positions(t.scored.filter(half), 5, 0.1)
    return rows.withColumn("updated_at", F.col("base_datetime"))


_LAST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_datetime DESC, event_id DESC) AS rn FROM scored WHERE {w})
WHERE rn = 1"""


@case("snk_08_upsert_vessels", sql.over("""
SELECT coalesce(a.mmsi, b.mmsi) AS mmsi,
  CASE WHEN a.mmsi IS NULL THEN coalesce(b.vessel_name, '') ELSE coalesce(a.vessel_name, '') END AS vessel_name,
  CASE WHEN a.mmsi IS NULL THEN b.vessel_type ELSE a.vessel_type END AS vessel_type,
  coalesce(b.lat, a.lat) AS lat, coalesce(b.base_datetime, a.base_datetime) AS base_datetime,
  coalesce(b.anomaly_type, a.anomaly_type) AS anomaly_type, coalesce(b.risk_level, a.risk_level) AS risk_level
FROM old_rows a FULL JOIN new_rows b ON a.mmsi = b.mmsi""", old_rows=_LAST.format(w="day <= 15"), new_rows=_LAST.format(w="day > 15")))
def _(t):
    empty = t.spark.createDataFrame([], scoring.LATEST_COLUMNS)
    first = scoring.upsert_vessels(empty, _live_half(t, "day <= 15"))
    second = scoring.upsert_vessels(first, _live_half(t, "day > 15"))
    return second.select("mmsi", "vessel_name", "vessel_type", "lat", "base_datetime", "anomaly_type", "risk_level")


@case("snk_09_append_alerts", sql.over("SELECT * REPLACE (false AS is_resolved) FROM alerts"))
def _(t):
    path = scratch_dir(t.spark, "alerts")
    for part in (alerts.anomaly_alerts(t.scored), alerts.collision_alerts(t.near_misses)):
        tables.append_evolving(alerts.with_alert_defaults(part), path)
    return t.spark.read.parquet(path)


_TRACK_SQL = f"""
SELECT mmsi, substring(coalesce(vessel_name, ''), 1, 100) AS vessel_name,
  CASE vessel_type WHEN '30' THEN 'Fishing' WHEN '31' THEN 'Towing' WHEN '36' THEN 'Sailing' WHEN '52' THEN 'Tug'
    WHEN '60' THEN 'Passenger' WHEN '70' THEN 'Cargo' WHEN '80' THEN 'Tanker' ELSE vessel_type END AS vessel_type,
  lat, lon, {sql.half_even("lat")} AS lat_bin, {sql.half_even("lon")} AS lon_bin, coalesce(sog, 0) AS sog,
  coalesce(cog, 0) AS cog, coalesce(heading, 0) AS heading, status, risk_level, false AS is_anomaly,
  CAST(0 AS DOUBLE) AS anomaly_score, '' AS anomaly_type, base_datetime, {AS_OF} AS ingested_at, 'train' AS data_split
FROM silver WHERE data_split = 'train'"""


@case("snk_10_track_fact", sql.over(_TRACK_SQL))
def _(t):
    return tables.track_fact(t.silver, ingested_at=t.as_of)


@case("snk_10b_track_fact_sampled")
def _(t):
    return tables.track_fact(t.silver, share=0.10, target_rows=2_000_000, ingested_at=t.as_of)


@case("snk_11_upsert_weather", sql.over(f"""
SELECT lat_cell, lon_cell, hour_bucket, CASE WHEN hour(hour_bucket) >= 12 THEN wind_speed_10m + 1 ELSE wind_speed_10m END AS wind_speed_10m
FROM weather WHERE lat_cell % 2 = 0 OR hour(hour_bucket) >= 12"""))
def _(t):
    from wakeline.operators import merge

    rows = t.weather.select("lat_cell", "lon_cell", "hour_bucket", "wind_speed_10m")
    new = rows.filter(F.hour("hour_bucket") >= 12).withColumn("wind_speed_10m", F.col("wind_speed_10m") + 1)
    return merge.upsert(rows.filter("lat_cell % 2 = 0"), new, ("lat_cell", "lon_cell", "hour_bucket"))


_DENSITY_KEY = ("lat_bin", "lon_bin", "hour_bucket", "data_split")
_ZONES = sql.boxes("lat_bin", "lon_bin", warehouse.C.COASTAL_ZONES)


def _loaded(t):
    """Two loads, a repeat of the second, and the tables after them."""
    now = t.as_of
    control = t.spark.createDataFrame([], warehouse.CONTROL_COLUMNS)
    stored = t.spark.createDataFrame([], t.density.schema)
    half = t.density.filter("hour_bucket < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    from wakeline.session import materialise

    for source in (half, t.density, t.density):
        stored, control = warehouse.incremental_load(
            stored, control, source, "density", _DENSITY_KEY, "hour_bucket", now, ("lat_bin", "lon_bin"))
        stored, control = materialise(stored, "stored"), materialise(control, "control")
    return stored, control


@case("snk_12_incremental_load", sql.over(f"SELECT * FROM density WHERE {_ZONES}"))
def _(t):
    return _loaded(t)[0]


@case("snk_12b_load_control", sql.over(f"""
SELECT 'density' AS table_name, max(hour_bucket) AS last_loaded, count(*) AS rows_loaded, {AS_OF} AS updated_at
FROM density WHERE {_ZONES}"""))
def _(t):
    return _loaded(t)[1]


def _two_loads(t, source, table, keys, time):
    """A first load of older rows whose newest ones change afterwards, then a load of everything."""
    from wakeline.session import materialise

    source = source.withColumn("n", F.lit(1))
    early = source.filter(F.col(time).cast("timestamp_ntz") <= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    stored, control = t.spark.createDataFrame([], source.schema), t.spark.createDataFrame([], warehouse.CONTROL_COLUMNS)
    for rows in (early, source.withColumn("n", F.lit(2))):
        stored, control = warehouse.incremental_load(stored, control, rows, table, keys, time, t.as_of)
        stored, control = materialise(stored, "stored"), materialise(control, "control")
    return stored


_EARLY = "TIMESTAMP '2024-01-16 00:00:00'"


def _loads_sql(table: str, time: str) -> str:
    """What lies before the newest time of the first load keeps its first version."""
    mark = f"(SELECT max({time}) FROM {table} WHERE {time} <= {_EARLY})"
    return f"SELECT *, CASE WHEN {time} < {mark} THEN 1 ELSE 2 END AS n FROM {table}"


@case("snk_12c_load_daily", sql.over(_loads_sql("daily", "stat_date")))
def _(t):
    return _two_loads(t, t.daily, "daily_stats", ("stat_date", "data_split"), "stat_date")


@case("snk_12d_load_latest", sql.over(_loads_sql("latest", "updated_at")))
def _(t):
    return _two_loads(t, t.latest, "vessel_latest", ("mmsi",), "updated_at")


@case("snk_12e_load_density", sql.over(_loads_sql("density", "hour_bucket")))
def _(t):
    return _two_loads(t, t.density, "traffic_density", _DENSITY_KEY, "hour_bucket")


@case("snk_13_message_records", sql.over(f"SELECT mmsi AS key, event_id, base_datetime, lat, lon, vessel_name FROM ais"))
def _(t):
    sent = tables.message_records(t.reports.select(*REPORT_COLUMNS))
    back = F.from_json("value", "event_id long, base_datetime timestamp_ntz, lat double, lon double, vessel_name string")
    return sent.select("key", back.alias("v")).select("key", "v.*")


@case("snk_14_typed_table", sql.over("""
SELECT mmsi, vessel_name, lat, lon, anomaly_type, anomaly_score, sog, heading_change, risk_level, base_datetime, data_split
FROM scored WHERE is_anomaly"""))
def _(t):
    path = scratch_dir(t.spark, "gold-anomalies")
    tables.create_empty(t.spark, path, tables.TABLE_COLUMNS["anomalies"])
    alerts.gold_anomalies(t.scored).write.mode("append").parquet(path)
    return t.spark.read.schema(tables.TABLE_COLUMNS["anomalies"]).parquet(path)


@case("snk_15_register_table", sql.over("SELECT stat_date, total_records FROM daily"))
def _(t):
    path = scratch_dir(t.spark, "daily")
    tables.overwrite_snapshot(t.daily, path)
    return tables.register(t.spark, f"daily_stats_{uuid.uuid4().hex}", path).select("stat_date", "total_records")


@case("snk_16_rewrite_clustered", sql.over(f"SELECT {_SHORT} FROM silver WHERE mmsi BETWEEN '360000020' AND '360000040'"))
def _(t):
    path = scratch_dir(t.spark, "clustered")
    tables.rewrite_clustered(t.silver, path)
    return t.spark.read.parquet(path).filter("mmsi BETWEEN '360000020' AND '360000040'").select(*SHORT)


_STATUS_VALUES = ", ".join(
    f"('{code}', '{warehouse.C.STATUS_SHARED[code]}', " + ", ".join(str(f).lower() for f in flags) + ")"
    for code, flags in warehouse.C.STATUS_FLAGS.items())


@case("snk_17_status_dimension", sql.over(f"""
SELECT status_label, is_underway, is_stopped, is_anchored, is_moored, is_aground, count(*) AS reports
FROM ais JOIN (VALUES {_STATUS_VALUES}) s(code, status_label, is_underway, is_stopped, is_anchored, is_moored, is_aground)
  ON ais.status = s.code GROUP BY ALL"""))
def _(t):
    dim = tables.status_dimension(t.spark)
    names = ["status_label", "is_underway", "is_stopped", "is_anchored", "is_moored", "is_aground"]
    counts = t.reports.groupBy("status").agg(F.count("*").alias("reports"))
    return counts.join(dim, counts.status == dim.status_code).select(*names, "reports")


@case("snk_18_resolve_alert", sql.over(f"""
SELECT id, is_resolved OR id = low AS is_resolved, CASE WHEN id = low THEN {AS_OF} END AS resolved_at
FROM alerts, (SELECT min(id) AS low FROM alerts WHERE NOT is_resolved)"""))
def _(t):
    first = t.alerts.filter("NOT is_resolved").agg(F.min("id")).first()[0]
    return alerts.resolve(t.alerts, first or 0, t.as_of).select("id", "is_resolved", "resolved_at")


@case("snk_19_retention", sql.over(f"SELECT {_SHORT} FROM silver WHERE base_datetime >= {AS_OF} - INTERVAL 15 DAY"))
def _(t):
    return tables.retained(t.silver, t.as_of, 15).select(*SHORT)




@case("snk_19b_retention_by_partition", sql.over(f"SELECT {_SHORT} FROM silver WHERE base_datetime >= {AS_OF} - INTERVAL 372 HOUR"))
def _(t):
    path = _silver_path(t)
    maintenance.drop_before(t.spark, path, datetime(2024, 1, 31) - timedelta(hours=372))
    return t.spark.read.parquet(path).select(*SHORT)


@case("snk_16b_compacted_batches", sql.over("SELECT mmsi, base_datetime, lat, lon FROM silver"))
def _(t):
    """Silver in a folder for each of thirty batches, compacted twice on the way."""
    path = scratch_dir(t.spark, "batches")
    out = maintenance.BatchFolders(t.spark, path, "mmsi STRING, base_datetime TIMESTAMP_NTZ, lat DOUBLE, lon DOUBLE")
    rows = t.silver.select("mmsi", "base_datetime", "lat", "lon")
    for first in (0, 10, 20):
        some = rows.withColumn("batch_id", F.pmod(F.xxhash64("mmsi", "base_datetime"), F.lit(30)).cast("int"))
        some = some.filter(F.col("batch_id").between(first, first + 9)).withColumn("query_id", F.lit("q"))
        some.write.mode("append").partitionBy("query_id", "batch_id").parquet(path)
        out.compact()
    return out.read()
