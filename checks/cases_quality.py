"""DQ-*: quality rules over the raw reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql
from checks.registry import case
from checks.sql import AS_OF, dec
from wakeline.quality import checks as quality

_SPOILED = ("CASE WHEN event_id % 31 = 0 THEN '12345' WHEN event_id % 37 = 0 THEN 'abc' WHEN event_id % 41 = 0 THEN '199000001' "
            "WHEN event_id % 43 = 0 THEN '970000001' ELSE mmsi END")


def _spoiled(t):
    return t.reports.withColumn("mmsi", F.expr(_SPOILED))


_SPOILED_SQL = f"SELECT * REPLACE ({_SPOILED} AS mmsi) FROM ais"


def _suite(name: str, rule: str, mostly: float) -> str:
    share = f"count(*) FILTER (WHERE {rule}) / CAST(count({rule}) AS DOUBLE)"
    return f"SELECT '{name}' AS expectation, {dec(share, 6)} AS observed, {share} >= CAST({mostly} AS DOUBLE) AS passed FROM spoiled"


_RULES = [("mmsi_nine_digits", "regexp_full_match(mmsi, '[0-9]{9}')", 0.99), ("lat_in_range", "lat BETWEEN -90 AND 90", 0.999),
          ("lon_in_range", "lon BETWEEN -180 AND 180", 0.999), ("sog_in_range", "sog BETWEEN 0 AND 102", 0.999),
          ("cog_in_range", "cog BETWEEN 0 AND 360", 0.999), ("heading_in_range", "heading BETWEEN 0 AND 511", 0.999),
          ("base_datetime_present", "(base_datetime IS NOT NULL)", 1.0), ("not_null_island", "(NOT (lat = 0 AND lon = 0))", 1.0)]


@case("dq_01_expectation_suite", sql.over(" UNION ALL ".join(_suite(*r) for r in _RULES) + """
UNION ALL SELECT 'row_count', CAST(count(*) AS DOUBLE), count(*) BETWEEN 7000000 AND 11000000 FROM spoiled
UNION ALL SELECT 'vessel_count', CAST(count(DISTINCT mmsi) AS DOUBLE), count(DISTINCT mmsi) BETWEEN 20000 AND 50000 FROM spoiled""",
                                          spoiled=_SPOILED_SQL))
def _(t):
    return quality.run_suite(_spoiled(t))


_VERDICT = ("CASE WHEN NOT regexp_full_match(mmsi, '[0-9]+') THEN 'non-numeric' WHEN length(mmsi) <> 9 THEN 'wrong_length_' || length(mmsi) "
            "WHEN CAST(mmsi[1:3] AS INTEGER) < 201 OR (CAST(mmsi[1:3] AS INTEGER) > 775 AND CAST(mmsi[1:3] AS INTEGER) < 970) "
            "THEN 'invalid_mid_prefix' ELSE 'valid' END")


@case("dq_02_mmsi_verdict", sql.over(f"SELECT event_id, mmsi, {_VERDICT} AS verdict FROM spoiled", spoiled=_SPOILED_SQL))
def _(t):
    return _spoiled(t).select("event_id", "mmsi", quality.mmsi_verdict().alias("verdict"))


@case("dq_03_teleport_flags", sql.over(f"""
SELECT event_id, coalesce(time_delta_sec <= 0 OR distance_nm * 3600 / time_delta_sec > 50, false) AS teleport
FROM ({sql.stepped('clean')})"""))
def _(t):
    rows = t.clean.select("event_id", "mmsi", "base_datetime", "lat", "lon")
    return quality.teleport_flags(rows).select("event_id", "teleport")


@case("dq_04_without_sentinels", sql.over("""
SELECT event_id, nullif(sog, CAST(102.3 AS DOUBLE)) AS sog, nullif(cog, 360) AS cog, nullif(heading, 511) AS heading,
  nullif(length, 0) AS length FROM ais"""))
def _(t):
    return quality.without_sentinels(t.reports).select("event_id", "sog", "cog", "heading", "length")


def _pct(condition: str) -> str:
    return dec(f"count(*) FILTER (WHERE {condition}) * 100 / CAST(count(*) AS DOUBLE)", 4)


@case("dq_06_daily_metrics", sql.over(f"""
SELECT CAST(base_datetime AS DATE) AS stat_date, count(*) AS row_count, {_pct("mmsi IS NULL OR trim(mmsi) = ''")} AS null_mmsi_pct,
  {_pct("NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)")} AS invalid_coords_pct, {_pct("lat = 0 AND lon = 0")} AS null_island_pct,
  {_pct("sog = CAST(102.3 AS DOUBLE)")} AS sentinel_sog_pct,
  {dec("(count(*) - count(DISTINCT (mmsi, base_datetime))) * 100 / CAST(count(*) AS DOUBLE)", 4)} AS duplicate_pct,
  count(DISTINCT mmsi) AS unique_vessel_count, count(*) FILTER (WHERE base_datetime > {AS_OF} - INTERVAL 5 DAY) AS future_timestamp_count
FROM ais GROUP BY 1"""))
def _(t):
    return quality.daily_metrics(t.reports, t.as_of - F.expr("INTERVAL '5' DAY"))


@case("dq_07_triage", sql.over(f"""
SELECT event_id, CASE WHEN {_VERDICT} <> 'valid' THEN 'quarantine' WHEN lat = 0 OR lon = 0 THEN 'drop' ELSE 'keep' END AS action
FROM spoiled""", spoiled=_SPOILED_SQL))
def _(t):
    return quality.triage(_spoiled(t)).select("event_id", "action")


@case("dq_07b_quarantined_rows", sql.over(
    f"SELECT event_id, mmsi, {_VERDICT} AS verdict FROM spoiled WHERE {_VERDICT} <> 'valid'", spoiled=_SPOILED_SQL))
def _(t):
    _, aside = quality.split_quarantine(_spoiled(t))
    return aside.select("event_id", "mmsi", quality.mmsi_verdict().alias("verdict"))


@case("dq_08_alert_bursts", sql.over("""
SELECT minute, alerts, count(*) OVER (PARTITION BY run) >= 2 AS storm FROM (
  SELECT *, epoch(minute) // 60 - row_number() OVER (ORDER BY minute) AS run FROM (
    SELECT date_trunc('minute', created_at) AS minute, count(*) AS alerts FROM alerts GROUP BY ALL)
  WHERE alerts > 1)"""))
def _(t):
    return quality.alert_bursts(t.alerts, per_minute=1, minutes=2)


TRAIN, REST = "data_split = 'train'", "data_split <> 'train'"
_FEATURES = ("sog", "cog", "distance_nm", "lat")


def _psi(f: str) -> str:
    place = f"least(10, greatest(1, CAST(floor(({f} - lo) / ((hi - lo) / 10)) AS INTEGER) + 1))"
    side = lambda name, w: (
        f"(SELECT {place} AS bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS {name} FROM silver, "
        f"(SELECT min({f}) AS lo, max({f}) AS hi FROM silver WHERE data_split = 'train') WHERE {w} AND {f} IS NOT NULL GROUP BY 1)")
    p, q = "greatest(coalesce(p, 0), CAST(0.0001 AS DOUBLE))", "greatest(coalesce(q, 0), CAST(0.0001 AS DOUBLE))"
    total = f"sum(({q} - {p}) * ln({q} / {p}))"
    return (f"SELECT '{f}' AS feature, {dec(total, 6)} AS psi, {dec(total, 6)} > 0.2 AS drifted "
            f"FROM {side('p', TRAIN)} a "
            f"FULL JOIN {side('q', REST)} b USING (bin)")


@case("dq_08b_drift", sql.over(" UNION ALL ".join(_psi(f) for f in _FEATURES)))
def _(t):
    return quality.drift(t.silver.filter("data_split = 'train'"), t.silver.filter("data_split <> 'train'"), _FEATURES)


def _ks(f: str) -> str:
    place = f"least(1000, CAST(floor(({f} - lo) / ((hi - lo) / 1000)) AS INTEGER) + 1)"
    gap = "abs(sum(p) OVER upto / CAST(sum(p) OVER () AS DOUBLE) - sum(q) OVER upto / CAST(sum(q) OVER () AS DOUBLE))"
    return (f"SELECT '{f}' AS feature, {dec('max(gap)', 6)} AS ks, {dec('max(gap)', 6)} > 0.1 AS drifted FROM (SELECT {gap} AS gap FROM "
            f"(SELECT {place} AS bin, count(*) FILTER ({TRAIN}) AS p, count(*) FILTER ({REST}) AS q FROM silver, "
            f"(SELECT min({f}) AS lo, max({f}) AS hi FROM silver) WHERE {f} IS NOT NULL GROUP BY 1) WINDOW upto AS (ORDER BY bin))")


@case("dq_08c_ks", sql.over(" UNION ALL ".join(_ks(f) for f in _FEATURES)))
def _(t):
    return quality.ks_distance(t.silver.filter(TRAIN), t.silver.filter(REST), _FEATURES)
