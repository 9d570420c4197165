"""Silver: one clean row per vessel and second, with labels and motion features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.config import DEFAULTS, Thresholds
from wakeline.functions import cells, cleaning, geo, labels
from wakeline.operators import tracks

MOTION_FIELDS = ("base_datetime", "lat", "lon", "sog", "heading")


def physical_validity(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """'Not available' codes become null first, so that the range checks let them pass."""
    df = df.withColumns({
        "sog": F.expr(f"nullif(sog, {C.SOG_NOT_AVAILABLE}D)"),
        "heading": F.expr(f"nullif(heading, {C.HEADING_NOT_AVAILABLE}D)"),
    })
    return df.filter(
        f"(sog IS NULL OR sog BETWEEN 0 AND {t.max_sog_kn}D) AND (cog IS NULL OR (cog >= 0 AND cog < 360)) "
        "AND (heading IS NULL OR (heading >= 0 AND heading < 360)) "
        "AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
    )


def _member(row: str, field: str) -> str:
    return f"{row}.{field}" if row else field


def step_distance(before: str, now: str = "") -> Column:
    """Miles between two rows given as struct columns ('' is the row itself), four decimals."""
    ends = [_member(row, c) for row in (before, now) for c in ("lat", "lon")]
    return F.round(geo.haversine_nm(*ends), 4)


def step_seconds(before: str, now: str = "") -> Column:
    return cleaning.seconds_between(_member(now, "base_datetime"), _member(before, "base_datetime"))


def implied_speed(distance: Column, seconds: Column) -> Column:
    """Knots between two reports; no time but some distance comes out impossibly fast, no distance as 0."""
    return distance / F.greatest(seconds / F.lit(3600.0), F.lit(1e-9))


def no_teleport(before: str, now: str, t: Thresholds = DEFAULTS) -> Column:
    return implied_speed(step_distance(before, now), step_seconds(before, now)) <= t.teleport_kn


def motion_features(df: DataFrame, prev: str = "prev") -> DataFrame:
    """Deltas to the row in struct ``prev``, plus the two grids. Null without a previous row."""
    return df.withColumns({
        "sog_change": F.expr(f"sog - {prev}.sog"),
        "heading_change": geo.turn_wrapped("heading", f"{prev}.heading"),
        "time_delta_sec": step_seconds(prev),
        "distance_nm": step_distance(prev),
        "lat_bin_fine": cells.fine("lat"),
        "lon_bin_fine": cells.fine("lon"),
        "lat_bin": cells.coordinate("lat", digits=1),
        "lon_bin": cells.coordinate("lon", digits=1),
    }).drop(prev)


def signed_motion(rows: DataFrame) -> DataFrame:
    """The other form of the deltas: signed turn, unrounded distance, fine cells cut toward zero."""
    linked = tracks.with_neighbour(rows, MOTION_FIELDS)
    return linked.withColumns({
        "sog_change": F.expr("sog - prev.sog"),
        "heading_change": geo.turn_signed("heading", "prev.heading"),
        "time_delta_sec": step_seconds("prev"),
        "distance_nm": geo.haversine_nm("prev.lat", "prev.lon", "lat", "lon"),
        "lat_bin_fine": cells.coordinate("lat", 0.01, "truncated"),
        "lon_bin_fine": cells.coordinate("lon", 0.01, "truncated"),
    }).drop("prev")


def with_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "vessel_type_label": labels.vessel_type_cleaned("vessel_type"),
        "status_label": labels.status_cleaned("status"),
    })


def clean(reports: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Deduplicated and physically possible reports."""
    return physical_validity(tracks.dedup_exact(reports), t)


def silver(bronze: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The full Silver table from gated Bronze rows.

    What can be derived again is not carried through the exchanges: cells, date parts and labels are added at the
    end, and the two ingest times are no part of Silver. Bronze is read and deduplicated once.
    """
    rows = clean(bronze.drop("event_time", "ingestion_time", "year", "month", "day", "hour", "lat_bin", "lon_bin"), t)
    rows = tracks.link_plausible(
        rows, MOTION_FIELDS, lambda a, b: no_teleport(a, b, t), fill=("vessel_name", "vessel_type", "imo")
    )
    rows = with_labels(motion_features(rows).dropna(subset=["time_delta_sec", "distance_nm"]))
    at = F.col("base_datetime")
    return rows.withColumns({
        "data_split": labels.data_split_by_day("base_datetime", t),
        "year": F.year(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "hour": F.hour(at),
    })
