"""Bronze: quality gates, speed flags, geofence, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wakeline import config as C
from wakeline.config import DEFAULTS, Thresholds
from wakeline.functions import cells, cleaning, labels


def valid_position(lat: str = "lat", lon: str = "lon") -> Column:
    """Both numbers present, not zero, not NaN (no range holds it), on the globe."""
    return F.expr(
        f"coalesce({lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 AND {lat} <> 0 AND {lon} <> 0, false)"
    )


def batch_gate(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The gate of the batch and stream path: key, position and speed must be usable."""
    return df.filter(
        (F.col("mmsi") != "")
        & valid_position()
        & F.col("sog").between(0, t.max_sog_kn)
    )


def loose_gate(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The looser gate: values are cast first, zero positions and an empty key pass."""
    lat, lon, sog = (F.col(c).try_cast("double") for c in ("lat", "lon", "sog"))
    return df.filter(
        F.col("mmsi").isNotNull() & lat.between(-90, 90) & lon.between(-180, 180)
        & sog.between(0, t.max_sog_kn)
    )


def speed_flags(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    sog = F.col("sog")
    return df.withColumns({
        "is_stopped": sog < t.stopped_kn,
        "is_slow": sog < t.slow_kn,
        "is_speeding": sog > t.speeding_kn,
    })


def with_risk(df: DataFrame, t: Thresholds = DEFAULTS, boxes=C.PORT_BOXES) -> DataFrame:
    df = df.withColumn("in_us_port_zone", labels.in_any_box("lat", "lon", boxes))
    return df.withColumn(
        "risk_level",
        labels.risk_level("sog", "in_us_port_zone", t.stopped_kn, t.slow_kn),
    )


def time_columns(df: DataFrame, source: str = "base_datetime") -> DataFrame:
    """event_time, ingestion_time and date parts; unreadable times give nulls."""
    at = F.col(source)
    if isinstance(df.schema[source].dataType, StringType):
        at = F.coalesce(at.try_cast("timestamp_ntz"), cleaning.report_time(source))
    return df.withColumns({
        "event_time": at,
        "ingestion_time": F.localtimestamp(),
        "year": F.year(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "hour": F.hour(at),
    })


def enrich(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Everything the Bronze table adds to a gated report; one projection, no shuffle."""
    df = with_risk(speed_flags(time_columns(df), t), t)
    return df.withColumns({
        "lat_bin": cells.coordinate("lat", digits=1),
        "lon_bin": cells.coordinate("lon", digits=1),
    })


def bronze(reports: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return enrich(batch_gate(reports, t), t)

