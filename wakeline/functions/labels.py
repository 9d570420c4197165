"""Code-to-label lookups as literal maps, and the rule-based classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.config import DEFAULTS, Box, Thresholds


def lookup_sql(code: str, table: dict) -> str:
    """Value of ``code`` in a small fixed table, null when it is missing."""
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    pairs = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items())
    return f"try_element_at(map({pairs}), {code})"


def vessel_type_cleaned(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(code, C.VESSEL_TYPES_CLEANED)}, {code})")


def vessel_type_shared(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(code, C.VESSEL_TYPES_SHARED)}, concat('Type ', {code}))")


def vessel_type_track(raw: str) -> Column:
    """Track load: '' for nothing, label for a known code, the code or text itself otherwise."""
    text = f"trim(CAST({raw} AS STRING))"
    code = f"CAST(try_cast(nullif(try_cast({text} AS DOUBLE), CAST('NaN' AS DOUBLE)) AS BIGINT) AS STRING)"
    return F.expr(
        f"CASE WHEN {text} IS NULL OR {text} IN ('', 'nan', 'None') THEN '' "
        f"ELSE coalesce({lookup_sql(code, C.VESSEL_TYPES_TRACK)}, {code}, {text}) END"
    )


def vessel_type_numeric(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(f'try_cast({code} AS INT)', C.VESSEL_TYPES_NUMERIC)}, 'Unknown')")


def vessel_type_screen(raw: str) -> Column:
    """Live table: '70' and '70.0' share a label, unknown codes pass, null is 'Unknown'."""
    text = f"trim(CAST({raw} AS STRING))"
    code = f"regexp_replace({text}, '[.]0$', '')"
    return F.expr(f"coalesce({lookup_sql(code, C.VESSEL_TYPES_SCREEN)}, {text}, 'Unknown')")


def vessel_type_ranges(raw: str) -> Column:
    """Query service: code ranges; text that is no number passes unchanged."""
    code = f"try_cast(try_cast({raw} AS DOUBLE) AS INT)"
    return F.expr(
        f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN 'Unknown Vessel Type' WHEN {code} IS NULL THEN {raw} "
        f"WHEN {code} BETWEEN 70 AND 79 THEN 'Cargo' WHEN {code} BETWEEN 80 AND 89 THEN 'Tanker' "
        f"WHEN {code} BETWEEN 60 AND 69 THEN 'Passenger' WHEN {code} = 30 THEN 'Fishing' "
        f"WHEN {code} IN (31, 32, 52) THEN 'Towing / Tug' WHEN {code} = 35 THEN 'Military' "
        f"WHEN {code} = 36 THEN 'Sailing' WHEN {code} = 37 THEN 'Pleasure Craft' ELSE 'Unknown Vessel Type' END"
    )


def status_cleaned(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(code, C.STATUS_CLEANED)}, {code})")


def status_shared(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(code, C.STATUS_SHARED)}, concat('Status ', {code}))")


def status_numeric(code: str) -> Column:
    return F.expr(f"coalesce({lookup_sql(f'try_cast({code} AS INT)', C.STATUS_NUMERIC)}, 'Unknown')")


def box_sql(lat: str, lon: str, box: Box) -> str:
    return (
        f"({lat} BETWEEN {box.lat_min}D AND {box.lat_max}D AND {lon} BETWEEN {box.lon_min}D AND {box.lon_max}D)"
    )


def in_box(lat: str, lon: str, box: Box) -> Column:
    return F.expr(box_sql(lat, lon, box))


def in_any_box(lat: str, lon: str, boxes: Sequence[Box] = C.PORT_BOXES) -> Column:
    return F.expr(" OR ".join(box_sql(lat, lon, box) for box in boxes))


def in_us_waters(lat: str, lon: str) -> Column:
    return in_box(lat, lon, C.US_WATERS)


def risk_level(sog: str, inside: str, stopped_kn=DEFAULTS.stopped_kn, slow_kn=DEFAULTS.slow_kn) -> Column:
    """HIGH when nearly stopped inside a watched box, MEDIUM when slow, LOW otherwise (also null sog)."""
    return F.expr(
        f"CASE WHEN {sog} < {stopped_kn}D AND {inside} THEN 'HIGH' WHEN {sog} < {slow_kn}D THEN 'MEDIUM' ELSE 'LOW' END"
    )


def risk_level_legacy(sog: str, lat: str, lon: str) -> Column:
    return risk_level(sog, box_sql(lat, lon, C.LEGACY_RISK_BOX), stopped_kn=1.0)


def region(lat: str, lon: str, with_lakes: bool = True) -> Column:
    """Coastal region, first rule that matches."""
    arms = []
    for name, west, east, south, north in C.REGION_RULES if with_lakes else C.REGION_RULES[:3]:
        hit = f"{lon} BETWEEN {west} AND {east}"
        if south is not None:
            hit += f" AND {lat} BETWEEN {south} AND {north}"
        arms.append(f"WHEN {hit} THEN '{name}'")
    return F.expr(f"CASE {' '.join(arms)} ELSE '{C.REGION_OTHER}' END")


def congestion_level(count: str, high=DEFAULTS.congestion_high, medium=DEFAULTS.congestion_medium) -> Column:
    return F.expr(f"CASE WHEN {count} >= {high} THEN 'HIGH' WHEN {count} >= {medium} THEN 'MEDIUM' ELSE 'LOW' END")


def alert_severity(score: str) -> Column:
    return F.expr(f"CASE WHEN {score} >= 0.7D THEN 'HIGH' WHEN {score} >= 0.5D THEN 'MEDIUM' ELSE 'LOW' END")


def anomaly_text(kind: str, mmsi: str, score: str) -> Column:
    return F.expr(f"format_string('%s detected for vessel %s — score %.2f', {kind}, {mmsi}, coalesce({score}, 0D))")


def near_miss_text(mmsi_1: str, mmsi_2: str, distance: str, converging: str) -> Column:
    """``distance`` is text of two decimals."""
    return F.expr(
        f"concat('Vessels ', {mmsi_1}, ' and ', {mmsi_2}, ' are ', {distance}, ' nm apart', "
        f"if({converging}, ' and converging', ''))"
    )


def data_split_by_day(at: str, t: Thresholds = DEFAULTS) -> Column:
    return F.expr(
        f"CASE WHEN dayofmonth({at}) <= {t.train_last_day} THEN 'train' "
        f"WHEN dayofmonth({at}) = {t.test_day} THEN 'test' ELSE 'live' END"
    )


def weather_severity(wind: str, wave: str) -> Column:
    """0 to 1 from wind and wave; wind alone inland, 0 without wind."""

    def share(x: str, ceiling: float) -> str:
        return f"(CASE WHEN {x} > {ceiling}D THEN 1D WHEN {x} < 0 THEN 0D ELSE {x} / {ceiling}D END)"

    w, v = share(wind, C.WIND_CEILING), share(wave, C.WAVE_CEILING)
    return F.expr(
        f"coalesce(CASE WHEN {wave} IS NULL THEN {w} ELSE {C.WIND_WEIGHT}D * {w} + {C.WAVE_WEIGHT}D * {v} END, 0D)"
    )


def ordinal(level: str, table: dict = C.SEVERITY_ORDER) -> Column:
    """Rank of a level, so that ordering is by meaning and not by spelling."""
    return F.expr(f"coalesce({lookup_sql(level, table)}, 0)")
