"""ST-* and the streaming sources and sinks: a stream read to its end must equal the batch result."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from checks import sql
from checks.cases_models import forest, position_model
from checks.cases_windows import KEYS
from checks.registry import case
from checks.sql import dec
from wakeline.models import isolation_forest, live, runs, supervised
from wakeline.operators import tracks
from wakeline.plans import alerts
from wakeline.plans import bronze as bronze_plan
from wakeline.session import scratch_dir
from wakeline.sinks import tables
from wakeline.streaming import bronze, motion, scoring, sources, state, storms

COLUMNS = sources.MESSAGE_COLUMNS + ", event_id BIGINT"
FILES_PER_SPAN = 4
_FOLDERS: dict[tuple, str] = {}


def _once(t, name: str, make) -> str:
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _FOLDERS:
        path = scratch_dir(t.spark, name)
        make(path)
        _FOLDERS[key] = path
    return _FOLDERS[key]


def _messages(rows: DataFrame) -> DataFrame:
    at = F.date_format("base_datetime", "yyyy-MM-dd HH:mm:ss")
    return tables.message_records(rows.withColumn("base_datetime", at)).select("value")


def _write_in_time_order(rows: DataFrame, path: str) -> None:
    """Message files as they would arrive: one span of days after the other."""
    for first in range(1, 32, 5):
        span = rows.filter(F.dayofmonth("base_datetime").between(first, first + 4))
        _messages(span).repartition(FILES_PER_SPAN).write.mode("append").text(path)


def all_messages(t) -> str:
    return _once(t, "messages", lambda path: _write_in_time_order(t.reports, path))


def unique_messages(t) -> str:
    gated = bronze_plan.batch_gate(t.reports)
    return _once(t, "unique-messages", lambda path: _write_in_time_order(tracks.dedup_exact(gated), path))


def _stream(t, folder: str) -> DataFrame:
    return sources.file_stream(t.spark, folder, FILES_PER_SPAN)


def _in_batches(t, rows: DataFrame, path: str, batches: int) -> DataFrame:
    """The files below ``path`` as a stream of about so many batches, however many tasks have written them."""
    files = len(t.spark.read.schema(rows.schema).parquet(path).inputFiles())
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, files // batches)).parquet(path)


def _finished(query) -> None:
    query.awaitTermination()


def _gated(t, folder: str) -> DataFrame:
    rows = bronze_plan.batch_gate(sources.parse(_stream(t, folder), COLUMNS))
    return rows.withColumn("event_time", F.col("base_datetime").try_cast("timestamp_ntz"))


_BRONZE = ("mmsi, base_datetime, lat, lon, sog, cog, heading, vessel_name, imo, call_sign, vessel_type, status, length, "
           "width, draft, cargo, transceiver_class, risk_level, is_stopped, is_slow, is_speeding, in_us_port_zone")
_BRONZE_SQL = sql.over(
    f"SELECT {_BRONZE}, {dec('lat', 1)} AS lat_bin, {dec('lon', 1)} AS lon_bin FROM bronze")


def _as_stored(rows: DataFrame) -> DataFrame:
    at = F.col("event_time").alias("base_datetime")
    names = [at if c == "base_datetime" else F.col(c) for c in _BRONZE.split(", ")]
    return rows.select(*names, "lat_bin", "lon_bin")


@case("src_04_message_stream", sql.over(f"SELECT {KEYS}, lat, lon, sog FROM ais"))
def _(t):
    raw = sources.parse(_stream(t, all_messages(t)), COLUMNS)
    path = scratch_dir(t.spark, "src04")
    _finished(bronze.append_direct(raw, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(raw.schema).parquet(path).select(
        "event_id", "mmsi", F.col("base_datetime").cast("timestamp_ntz").alias("base_datetime"), "lat", "lon", "sog")


@case("src_05_parse_messages", sql.over(f"SELECT {KEYS}, lat, heading, vessel_name, length FROM ais WHERE event_id % 7 <> 0"))
def _(t):
    value = F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(F.col("value"))
    at = F.date_format("base_datetime", "yyyy-MM-dd HH:mm:ss")
    rows = t.reports.withColumn("base_datetime", at)
    raw = rows.withColumn("value", F.to_json(F.struct(*rows.columns))).select(value.alias("value"))
    parsed = sources.parse(raw, COLUMNS).filter(F.col("mmsi").isNotNull())
    return parsed.select(
        "event_id", "mmsi", F.col("base_datetime").cast("timestamp_ntz").alias("base_datetime"), "lat", "heading",
        "vessel_name", "length")


@case("st_01_bronze_stream", _BRONZE_SQL)
def _(t):
    rows = bronze.bronze_stream(_stream(t, all_messages(t)))
    path = scratch_dir(t.spark, "bronze-direct")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return _as_stored(t.spark.read.schema(rows.schema).parquet(path))


@case("snk_05_batch_append", _BRONZE_SQL)
def _(t):
    rows = bronze.bronze_stream(_stream(t, all_messages(t)))
    path = scratch_dir(t.spark, "bronze-batches")
    _finished(bronze.append_batches(rows, path, scratch_dir(t.spark, "cp"), bronze.UNTIL_DONE))
    return _as_stored(t.spark.read.parquet(path).drop("query_id", "batch_id"))


@case("snk_06_direct_append", sql.over("SELECT mmsi, count(*) AS reports, min(base_datetime) AS first_seen FROM bronze GROUP BY 1"))
def _(t):
    rows = bronze.bronze_stream(_stream(t, all_messages(t)))
    path = scratch_dir(t.spark, "bronze-direct")
    checkpoint = scratch_dir(t.spark, "cp")
    for _ in range(2):  # started again on the same checkpoint it finds nothing new
        _finished(bronze.append_direct(rows, path, checkpoint))
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("mmsi").agg(F.count("*").alias("reports"), F.min("event_time").alias("first_seen"))


@case("st_02_micro_batches", sql.over("SELECT count(*) AS reports, true AS several_batches FROM bronze"))
def _(t):
    rows = bronze.bronze_stream(_stream(t, all_messages(t)))
    path = scratch_dir(t.spark, "micro")
    _finished(bronze.append_batches(rows, path, scratch_dir(t.spark, "cp"), bronze.UNTIL_DONE))
    return t.spark.read.parquet(path).agg(
        F.count("*").alias("reports"), (F.countDistinct("batch_id") > 1).alias("several_batches"))


def _scoring_run(t) -> str:
    def make(path: str) -> None:
        rows = scoring.live_reports(_stream(t, unique_messages(t)))
        _finished(scoring.start_scoring(rows, path, scratch_dir(t.spark, "cp"), bronze.UNTIL_DONE))

    return _once(t, "scoring", make)


_LIVE = f"""
SELECT *, coalesce(sog - prev_sog, 0) AS sc, coalesce(abs(fmod(fmod(h0 - coalesce(p0, h0) + 180, 360) + 360, 360) - 180), 0) AS hc
FROM (SELECT *, coalesce(heading, 0) AS h0, lag(coalesce(heading, 0)) OVER (PARTITION BY mmsi ORDER BY base_datetime) AS p0
  FROM ({sql.lagged('bronze_once')}))"""
_H = "coalesce(nullif(heading, 0), nullif(cog, 0), 0)"
_MILES = "sog * (5 / CAST(60 AS DOUBLE))"


@case("st_03_score_batches", sql.over(f"""
SELECT mmsi, base_datetime, risk_level,
  CASE WHEN sog < 0.5 AND in_us_port_zone THEN 'STATIONARY_RISK' WHEN hc > 45 AND sog > 2 THEN 'SHARP_TURN'
    WHEN sog > 30 THEN 'UNUSUAL_SPEED' WHEN sc < -5 THEN 'SUDDEN_STOP' ELSE '' END AS anomaly_type,
  CASE WHEN sog < 0.5 AND in_us_port_zone THEN CAST(0.9 AS DOUBLE) WHEN hc > 45 AND sog > 2 THEN least(hc / 180, 1)
    WHEN sog > 30 THEN sog / 60 WHEN sc < -5 THEN CAST(0.8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS anomaly_score,
  CASE WHEN sog >= 0.1 THEN {dec(f"lat + {_MILES} * cos(radians({_H})) / 60", 6)} END AS predicted_lat,
  CASE WHEN sog >= 0.1 THEN {dec(f"lon + {_MILES} * sin(radians({_H})) / (60 * cos(radians(lat)) + CAST(0.000000001 AS DOUBLE))", 6)}
    END AS predicted_lon
FROM live""", live=_LIVE))
def _(t):
    return t.spark.read.parquet(f"{_scoring_run(t)}/scored").select(
        "mmsi", "base_datetime", "risk_level", "anomaly_type", "anomaly_score", "predicted_lat", "predicted_lon")


@case("st_04_latest_state", sql.over("""
SELECT mmsi, base_datetime, lat, lon, sog, cog, risk_level, 'live' AS data_split FROM (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_datetime DESC) AS rn FROM bronze_once) WHERE rn = 1"""))
def _(t):
    table = state.BucketTable(t.spark, f"{_scoring_run(t)}/latest", scoring.LATEST_COLUMNS, "mmsi").read()
    return table.select("mmsi", "base_datetime", "lat", "lon", "sog", "cog", "risk_level", "data_split")


_TYPE = ("CASE WHEN sog < 0.5 AND in_us_port_zone THEN 'STATIONARY_RISK' WHEN hc > 45 AND sog > 2 THEN 'SHARP_TURN' "
         "WHEN sog > 30 THEN 'UNUSUAL_SPEED' WHEN sc < -5 THEN 'SUDDEN_STOP' ELSE '' END")


@case("st_03b_live_alerts", sql.over(f"""
SELECT {sql.alert_id("kind", "mmsi", "''", "base_datetime")} AS id, kind AS alert_type, mmsi AS mmsi_1, base_datetime AS created_at,
  false AS is_resolved, 'live' AS data_split
FROM (SELECT *, {_TYPE} AS kind FROM live) WHERE kind <> ''""", live=_LIVE))
def _(t):
    alerts = t.spark.read.parquet(f"{_scoring_run(t)}/alerts")
    return alerts.filter("alert_type <> 'COLLISION_RISK'").select(
        "id", "alert_type", "mmsi_1", "created_at", "is_resolved", "data_split")


@case("st_03c_live_near_misses", sql.over(f"""
SELECT {sql.alert_id("'COLLISION_RISK'", "mmsi_1", "mmsi_2", "detected_at")} AS id, mmsi_1, mmsi_2, detected_at AS created_at,
  severity, vessel_name_1, {dec("dist", 3)} AS distance_nm, lat, lon, false AS is_resolved
FROM (SELECT *, row_number() OVER (PARTITION BY mmsi_1, mmsi_2, detected_at ORDER BY dist, event_id_1, event_id_2) AS place
  FROM ({sql.near_miss_sql("unknown_is_zero", 300)})) WHERE place = 1""",
  unknown_is_zero="SELECT * REPLACE (coalesce(heading, 0) AS heading, coalesce(sog, 0) AS sog) FROM bronze_once"))
def _(t):
    alerts = t.spark.read.parquet(f"{_scoring_run(t)}/alerts")
    return alerts.filter("alert_type = 'COLLISION_RISK'").select(
        "id", "mmsi_1", "mmsi_2", "created_at", "severity", "vessel_name_1", "distance_nm", "lat", "lon", "is_resolved")


def _live_models(t) -> str:
    """A run table with a forest and a five-minute position model in production."""
    def make(path: str) -> None:
        forest(t).save(t.spark, f"{path}/forest")
        live.save_position(position_model(t)[0], f"{path}/position")
        for name, folder in ((live.FOREST, "forest"), (live.position_name(5), "position")):
            runs.record(t.spark, f"{path}/runs", name, "first", "Production", f"{path}/{folder}", {}, {})

    return f"{_once(t, 'live-models', make)}/runs"


@case("st_03d_live_model", sql.over("SELECT count(*) AS reports, CAST(0 AS BIGINT) AS differing, true AS by_model FROM bronze_once"))
def _(t):
    """The stream scored with models against the same models over the whole table at once."""
    table = _live_models(t)
    path = scratch_dir(t.spark, "scored-by-model")
    rows = scoring.live_reports(_stream(t, unique_messages(t)))
    _finished(scoring.start_scoring(
        rows, path, scratch_dir(t.spark, "cp"), bronze.UNTIL_DONE, live.ModelHandle(t.spark, table)))
    got = ["is_anomaly", "anomaly_score", "anomaly_type", "predicted_lat", "predicted_lon", "method"]
    streamed = t.spark.read.parquet(f"{path}/scored").select("mmsi", "base_datetime", F.struct(*got).alias("ours"))
    numbers = {c: F.coalesce(c, F.lit(0.0)) for c in ("sog", "cog", "heading", "lat", "lon")}
    once = tracks.dedup_exact(bronze_plan.batch_gate(t.reports)).withColumns(numbers)
    once = bronze_plan.with_risk(alerts.batch_motion(once).withColumn("distance_nm", F.coalesce("distance_nm", F.lit(0.0))))
    f = forest(t)
    merged = alerts.merge_model(alerts.normalise_scores(
        isolation_forest.score(alerts.rule_anomalies(once), f), low=f.low, high=f.high))
    moved = supervised.with_predictions(merged, position_model(t)[0], 5, F.col("base_datetime"), min_sog=0.1)
    whole = moved.select("mmsi", "base_datetime", F.struct(*got).alias("theirs"))
    both = streamed.join(whole, ["mmsi", "base_datetime"], "full_outer")
    return both.agg(
        F.count("*").alias("reports"), F.count_if(~F.col("ours").eqNullSafe(F.col("theirs"))).alias("differing"),
        (F.count_if(F.expr("ours.anomaly_type = 'ML_ANOMALY' OR ours.method = 'gbt'")) > 0).alias("by_model"))


@case("st_05_motion_state", sql.over(f"""
SELECT event_id, mmsi, base_datetime, sog - prev_sog AS sog_change,
  CASE WHEN abs(heading - prev_heading) > 180 THEN 360 - abs(heading - prev_heading) ELSE abs(heading - prev_heading) END
    AS heading_change, time_delta_sec, distance_nm
FROM ({sql.stepped('bronze_once')})"""))
def _(t):
    path = scratch_dir(t.spark, "motion")
    _finished(motion.start_motion(_gated(t, unique_messages(t)), path, scratch_dir(t.spark, "cp")))
    return motion.stored_motion(t.spark, path)


@case("st_06_replay", sql.over("SELECT event_id, mmsi, base_datetime, lat, lon FROM silver WHERE data_split = 'live'"))
def _(t):
    stored = scratch_dir(t.spark, "silver-live")
    tables.write_partitioned(t.silver, stored)
    rows = sources.replay_stream(t.spark, stored, t.silver, 8)
    path = scratch_dir(t.spark, "replayed")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(rows.schema).parquet(path).select("event_id", "mmsi", "base_datetime", "lat", "lon")


@case("st_07_progress", sql.over("SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS several_batches, true AS each_once FROM ais"))
def _(t):
    rows = bronze.bronze_stream(_stream(t, all_messages(t)))
    log = scratch_dir(t.spark, "progress-log")
    listener = bronze.ProgressLog(t.spark, log)
    t.spark.streams.addListener(listener)
    try:
        query = bronze.append_direct(rows, scratch_dir(t.spark, "progress"), scratch_dir(t.spark, "cp"))
        _finished(query)
        last = query.lastProgress["batchId"]
        for _ in range(600):  # listeners hear of a batch a moment after it ended
            try:
                if bronze.progress_rows(t.spark, log).filter(F.col("batch_id") >= last).count():
                    break
            except AnalysisException:
                pass
            time.sleep(0.1)
    finally:
        t.spark.streams.removeListener(listener)
    found = bronze.progress_rows(t.spark, log)
    return found.agg(
        F.sum("input_rows").alias("input_rows"), (F.count("*") > 1).alias("several_batches"),
        (F.count("*") == F.countDistinct("batch_id")).alias("each_once"))


@case("st_08_new_critical", sql.over("SELECT id, mmsi_1, mmsi_2, created_at FROM alerts WHERE severity = 'CRITICAL'"))
def _(t):
    polls = scratch_dir(t.spark, "polls")
    t.alerts.write.parquet(polls)
    stored = t.spark.read.schema(t.alerts.schema)
    first = stored.parquet(*stored.parquet(polls).inputFiles())
    first.write.mode("append").parquet(polls)  # two polls that return the same alerts, which are found once
    stream = _in_batches(t, t.alerts, polls, 2)
    rows = bronze.new_critical(stream, "60 days")
    path = scratch_dir(t.spark, "critical")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(rows.schema).parquet(path).select("id", "mmsi_1", "mmsi_2", "created_at")


@case("st_09_without_repeats", sql.over("SELECT mmsi, base_datetime FROM bronze_once"))
def _(t):
    rows = bronze.without_repeats(_gated(t, all_messages(t)), "10 days").select(
        "mmsi", F.col("event_time").alias("base_datetime"))
    path = scratch_dir(t.spark, "no-repeats")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(rows.schema).parquet(path)


_CELL = "CAST(round({x} / CAST(0.1 AS DOUBLE)) AS BIGINT)"


@case("st_10_hourly_density", sql.over(f"""
SELECT date_trunc('hour', base_datetime) AS hour_bucket, {_CELL.format(x='lat')} AS lat_cell, {_CELL.format(x='lon')} AS lon_cell,
  count(*) AS vessel_count, count(DISTINCT mmsi) AS unique_vessels, {sql.avg('sog')} AS avg_sog, count(*) FILTER (WHERE sog < 0.5) AS stopped_count
FROM bronze_once GROUP BY 1, 2, 3
HAVING date_trunc('hour', min(base_datetime)) + INTERVAL 1 HOUR <= (SELECT max(base_datetime) FROM bronze_once) - INTERVAL 10 DAY"""))
def _(t):
    rows = bronze.hourly_density(_gated(t, unique_messages(t)), "10 days")
    path = scratch_dir(t.spark, "density-stream")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(rows.schema).parquet(path)


@case("dq_08d_storm_alerts", sql.over("""
SELECT min(minute) AS first_minute, min(minute) + INTERVAL 2 MINUTE AS certain_at,
  CAST(sum(alerts) FILTER (WHERE place <= 2) AS BIGINT) AS alerts FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY minute) AS place FROM (
    SELECT *, epoch(minute) // 60 - row_number() OVER (ORDER BY minute) AS run FROM (
      SELECT date_trunc('minute', created_at) AS minute, count(*) AS alerts FROM alerts GROUP BY ALL)
    WHERE alerts > 1))
GROUP BY run HAVING count(*) >= 2 AND min(minute) + INTERVAL 2 MINUTE <= (SELECT max(created_at) FROM alerts) - INTERVAL 8 DAY"""))
def _(t):
    sent = scratch_dir(t.spark, "alerts-sent")
    spans = range(1, 32, 5)
    for first in spans:
        t.alerts.filter(F.dayofmonth("created_at").between(first, first + 4)).write.mode("append").parquet(sent)
    stream = _in_batches(t, t.alerts, sent, len(spans))
    rows = storms.storm_alerts(stream, per_minute=1, minutes=2, delay="8 days")
    path = scratch_dir(t.spark, "storms")
    _finished(bronze.append_direct(rows, path, scratch_dir(t.spark, "cp")))
    return t.spark.read.schema(rows.schema).parquet(path)
