"""ML-*: rules, models, evaluation, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.cases_aggregates import LOWERED, TRAINING
from checks.registry import case
from checks.sql import dec
from wakeline import config as C
from wakeline.models import evaluation, isolation_forest, runs, scaling, supervised
from wakeline.operators import density as density_ops
from wakeline.operators import timesplit
from wakeline.plans import alerts, weather
from wakeline.session import materialise, scratch_dir


@case("ml_01_rule_anomalies", sql.over("SELECT event_id, is_anomaly, anomaly_score, anomaly_type FROM scored"))
def _(t):
    return alerts.rule_anomalies(t.silver).select("event_id", "is_anomaly", "anomaly_score", "anomaly_type")


@case("ml_02_rule_labels", sql.over("""
SELECT event_id, rule_type, rule_type <> '' AS rule_anomaly FROM (
  SELECT event_id, CASE WHEN time_delta_sec > 300 THEN 'AIS_GAP' WHEN sog > 30 THEN 'UNUSUAL_SPEED'
    WHEN abs(heading_change) > 45 AND sog > 2 THEN 'SHARP_TURN' WHEN sog_change < -5 THEN 'SUDDEN_STOP' ELSE '' END AS rule_type
  FROM silver)"""))
def _(t):
    return alerts.rule_labels(t.silver).select("event_id", "rule_type", "rule_anomaly")


_SCALED = ", ".join(
    dec(f"(coalesce({f}, 0) - avg(coalesce({f}, 0)) OVER ()) / stddev_pop(coalesce({f}, 0)) OVER ()", 6) + f" AS {f}_scaled"
    for f in C.FOREST_FEATURES)


@case("ml_03_scaling", sql.over(f"SELECT event_id, {_SCALED} FROM silver"))
def _(t):
    scaled = scaling.scale(t.silver, scaling.fit(t.silver, C.FOREST_FEATURES))
    return scaled.select("event_id", *[F.round(f"{f}_scaled", 6).alias(f"{f}_scaled") for f in C.FOREST_FEATURES])


_FORESTS: dict = {}


def forest(t):
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _FORESTS:
        _FORESTS[key] = isolation_forest.fit(t.silver, C.FOREST_FEATURES)
    return _FORESTS[key]


@case("ml_04_isolation_forest")
def _(t):
    return isolation_forest.score(t.silver, forest(t)).select("event_id", "mmsi", "base_datetime", "raw_score", "outlier")


@case("ml_04b_isolation_forest_wide")
def _(t):
    wide = isolation_forest.fit(t.silver, C.FOREST_FEATURES_WIDE, contamination=0.01)
    return isolation_forest.score(t.silver, wide).select("event_id", "raw_score", "outlier")


_UPGRADE = "event_id % 5 = 0 AND norm > anomaly_score"


@case("ml_05_merge_model", sql.over(f"""
SELECT event_id, is_anomaly OR {_UPGRADE} AS is_anomaly, CASE WHEN {_UPGRADE} THEN norm ELSE anomaly_score END AS anomaly_score,
  CASE WHEN {_UPGRADE} AND anomaly_type = '' THEN 'ML_ANOMALY' ELSE anomaly_type END AS anomaly_type
FROM (SELECT *, CAST(event_id % 100 AS DOUBLE) / 100 AS norm FROM scored)"""))
def _(t):
    given = t.scored.withColumns({"outlier": F.col("event_id") % 5 == 0, "norm": F.expr("event_id % 100 / 100D")})
    return alerts.merge_model(given).select("event_id", "is_anomaly", "anomaly_score", "anomaly_type")


@case("ml_05b_scored_by_forest")
def _(t):
    f = forest(t)
    scored = isolation_forest.score(t.scored, f)
    merged = alerts.merge_model(alerts.normalise_scores(scored, low=f.low, high=f.high))
    return merged.select("event_id", "is_anomaly", "anomaly_score", "anomaly_type")


_POSITION: dict = {}


def position_model(t):
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _POSITION:
        _POSITION[key] = supervised.train_position(t.silver, 5, min_rows=100)
    return _POSITION[key]


@case("ml_06_position_model")
def _(t):
    return position_model(t)[1]


_H = "coalesce(nullif(heading, 0), nullif(cog, 0), 0)"
_MILES = "coalesce(sog, 0) * (10 / CAST(60 AS DOUBLE))"


@case("ml_07_predict_fallback", sql.over(f"""
SELECT mmsi, {dec(f"lat + {_MILES} * cos(radians({_H})) / 60", 6)} AS predicted_lat,
  {dec(f"lon + {_MILES} * sin(radians({_H})) / (60 * cos(radians(lat)) + CAST(0.000000001 AS DOUBLE))", 6)} AS predicted_lon,
  'dead_reckoning' AS method, 10 AS minutes_ahead, CAST(0.65 AS DOUBLE) AS confidence FROM latest"""))
def _(t):
    return supervised.predict_with_models(t.latest, None, 10, t.as_of).select(
        "mmsi", "predicted_lat", "predicted_lon", "method", "minutes_ahead", "confidence")


@case("ml_07b_predict_by_model")
def _(t):
    return supervised.predict_with_models(t.latest, position_model(t)[0], 5, t.as_of)


def _cellhours(t):
    return t.stored("training", lambda: density_ops.training_density(t.silver, LOWERED))


_CONGESTION: dict = {}


def congestion_model(t):
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _CONGESTION:
        parts = supervised.hash_split(_cellhours(t), ("lat_cell", "lon_cell", "hour_bucket"))
        _CONGESTION[key] = supervised.train_congestion(parts.filter("part = 'train'"))
    return _CONGESTION[key]


@case("ml_08_congestion_model")
def _(t):
    parts = supervised.hash_split(_cellhours(t), ("lat_cell", "lon_cell", "hour_bucket"))
    tested = supervised.predict_congestion(parts.filter("part = 'test'"), congestion_model(t))
    return evaluation.rounded_classes(evaluation.class_report(tested, "congestion_level", "predicted_level"))


@case("ml_09_congestion_fallback", sql.over(f"""
SELECT lat_cell, lon_cell, hour_bucket, {sql.level("vessel_count")} AS predicted_level FROM training""", training=TRAINING))
def _(t):
    return supervised.predict_congestion(_cellhours(t), None).select("lat_cell", "lon_cell", "hour_bucket", "predicted_level")


@case("ml_09b_congestion_by_model")
def _(t):
    scored = supervised.predict_congestion(_cellhours(t), congestion_model(t))
    return scored.select("lat_cell", "lon_cell", "hour_bucket", "congestion_level", "predicted_level")


@case("ml_10_weather_challenger")
def _(t):
    rows = materialise(timesplit.next_hour_target(_cellhours(t)), "challenger")
    return supervised.weather_challenger(
        rows.drop("lat_cell", "lon_cell"), lambda df: weather.with_weather(df, t.weather), trees=20, depth=5)


_TRUTH = "(coalesce(sog_change < -5, false) OR (coalesce(abs(heading_change) > 45, false) AND coalesce(sog > 2, false)) OR coalesce(sog > 30, false) OR coalesce(time_delta_sec > 300000, false))"


@case("ml_11_anomaly_report", sql.over(f"""
SELECT n AS test_samples, {dec("flagged / CAST(n AS DOUBLE)", 4)} AS anomaly_rate, {dec("ruled / CAST(n AS DOUBLE)", 4)} AS rule_rate,
  {dec("p", 4)} AS precision, {dec("r", 4)} AS recall, {dec("2 * p * r / (p + r)", 4)} AS f1_score,
  {dec("false_hits / CAST(n AS DOUBLE)", 4)} AS estimated_false_positive_rate
FROM (SELECT *, hits / CAST(flagged AS DOUBLE) AS p, hits / CAST(ruled AS DOUBLE) AS r FROM (
  SELECT count(*) AS n, count(*) FILTER (WHERE o) AS flagged, count(*) FILTER (WHERE tr) AS ruled,
    count(*) FILTER (WHERE o AND tr) AS hits, count(*) FILTER (WHERE o AND NOT tr AND sog > 5) AS false_hits
  FROM (SELECT sog, event_id % 3 = 0 AS o, {_TRUTH.replace("300000", "300")} AS tr FROM
    (SELECT * REPLACE (time_delta_sec // 1000 AS time_delta_sec) FROM silver))))"""))
def _(t):
    given = t.silver.withColumn("outlier", F.col("event_id") % 3 == 0).withColumn(
        "time_delta_sec", F.expr("time_delta_sec div 1000"))
    return evaluation.anomaly_report(given)


_PREDICTED = "CASE WHEN (lat_cell + lon_cell) % 4 = 0 THEN 'MEDIUM' WHEN vessel_count >= 3 THEN 'HIGH' ELSE congestion_level END"
_CLASSES = f"""
SELECT c AS class, coalesce(hit / nullif(CAST(called AS DOUBLE), 0), 0) AS precision,
  coalesce(hit / nullif(CAST(actual AS DOUBLE), 0), 0) AS recall, actual, hit FROM (
  SELECT c, count(*) FILTER (WHERE tr = c) AS actual, count(*) FILTER (WHERE pr = c) AS called,
    count(*) FILTER (WHERE tr = c AND pr = c) AS hit
  FROM (SELECT congestion_level AS tr, {_PREDICTED} AS pr FROM training),
    (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) AS c) GROUP BY c) WHERE actual + called > 0"""
_F1 = "coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)"


def _class_report(t):
    return evaluation.class_report(
        _cellhours(t).withColumn("predicted_level", F.expr(_PREDICTED)), "congestion_level", "predicted_level")


@case("ml_12_class_report", sql.over(f"""
SELECT class, {dec("precision", 4)} AS precision, {dec("recall", 4)} AS recall, {dec(_F1, 4)} AS f1, actual AS support
FROM classes""", training=TRAINING, classes=_CLASSES))
def _(t):
    return evaluation.rounded_classes(_class_report(t))


@case("ml_12b_overall_report", sql.over(f"""
SELECT CAST(sum(actual) AS BIGINT) AS test_grid_cells, {dec("sum(hit) / CAST(sum(actual) AS DOUBLE)", 4)} AS accuracy,
  {dec(f"avg({_F1})", 4)} AS macro_f1, {dec("avg(precision)", 4)} AS macro_precision, {dec("avg(recall)", 4)} AS macro_recall
FROM classes""", training=TRAINING, classes=_CLASSES))
def _(t):
    return evaluation.overall(_class_report(t))


def _error(axis: str) -> str:
    return f"(p{axis} - d{axis})"


@case("ml_13_position_errors", sql.over(f"""
SELECT count(*) AS test_samples, {dec(f"avg(abs({_error('lat')})) * 60", 4)} AS mae_lat_nm,
  {dec(f"avg(abs({_error('lon')})) * 60", 4)} AS mae_lon_nm,
  {dec(f"sqrt(avg({_error('lat')} * {_error('lat')})) * 60", 4)} AS rmse_lat_nm,
  {dec(f"sqrt(avg({_error('lon')} * {_error('lon')})) * 60", 4)} AS rmse_lon_nm,
  {dec(f"60 * sqrt(avg(abs({_error('lat')})) * avg(abs({_error('lat')})) + avg(abs({_error('lon')})) * avg(abs({_error('lon')})))", 4)}
    AS total_mae_nm
FROM (SELECT next_lat - lat AS dlat, next_lon - lon AS dlon, sog / 600 AS plat, -sog / 500 AS plon FROM (
  SELECT *, lead(lat, 10) OVER w AS next_lat, lead(lon, 10) OVER w AS next_lon FROM silver
  WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime)) WHERE abs(next_lat - lat) < 1 AND abs(next_lon - lon) < 1)"""))
def _(t):
    rows = timesplit.future_position(t.silver, 5).withColumns({
        "pred_lat": F.expr("sog / 600D"), "pred_lon": F.expr("-sog / 500D")})
    return evaluation.position_errors(rows)


def _importances(t):
    parts = [
        isolation_forest.importance(t.spark, forest(t)).withColumn("model", F.lit("anomaly")),
        supervised.importance(t.spark, congestion_model(t), C.CONGESTION_FEATURES).withColumn("model", F.lit("congestion")),
        *[supervised.boosted_importance(model, C.POSITION_FEATURES).withColumn("model", F.lit(f"{axis}_5min"))
          for axis, model in position_model(t)[0].items()],
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@case("ml_14_importance")
def _(t):
    return _importances(t)


@case("ml_14b_importance_totals", """
SELECT unnest(['anomaly', 'congestion', 'lat_5min', 'lon_5min']) AS model, CAST(1 AS DOUBLE) AS total, true AS all_positive
""")
def _(t):
    return _importances(t).groupBy("model").agg(
        F.round(F.sum("importance"), 6).alias("total"), F.bool_and(F.col("importance") >= 0).alias("all_positive"))


@case("sl_05_top_features")
def _(t):
    return isolation_forest.importance(t.spark, forest(t)).orderBy(F.desc("importance"), "feature").limit(12)


@case("ml_15_run_record")
def _(t):
    table = scratch_dir(t.spark, "model-runs")
    report = evaluation.anomaly_report(isolation_forest.score(t.silver, forest(t))).first().asDict()
    runs.record(t.spark, table, "anomaly", "run-1", "Staging", "models/anomaly", {"trees": 200}, report)
    return t.spark.read.parquet(table)


# Runs derived from the daily statistics: one run per day, its stage by the day, its model by the split.
_RUNS = ("concat('model-', data_split) AS model, CAST(stat_date AS {s}) AS run, CASE WHEN day(stat_date) % 4 = 1 AND data_split <> 'test' "
         "THEN 'Production' WHEN day(stat_date) % 3 = 0 THEN 'Staging' WHEN day(stat_date) % 5 = 0 THEN 'file' ELSE 'Archived' END AS stage, "
         "concat('models/', CAST(stat_date AS {s})) AS path, CAST(stat_date AS {n}) AS logged_at")


@case("ml_16_choose_model", sql.over(f"""
SELECT model, run, path, CASE WHEN stage = 'file' THEN 'file' ELSE 'registry:' || stage END AS source FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY CASE stage WHEN 'Production' THEN 0 WHEN 'Staging' THEN 1 ELSE 2 END,
    logged_at DESC, run) AS rn FROM (SELECT {_RUNS.format(s="VARCHAR", n="TIMESTAMP")} FROM daily) WHERE stage <> 'Archived') WHERE rn = 1"""))
def _(t):
    derived = t.daily.selectExpr(*[p for p in _split_select(_RUNS.format(s="STRING", n="TIMESTAMP_NTZ"))])
    return runs.choose(derived)


def _split_select(text: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [*parts, current]
