"""Distances, bearings and dead reckoning as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import EARTH_RADIUS_NM


def _half_chord(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The root is held at 1, as rounding could push it out of the domain of asin."""
    term = _half_chord(lat1, lon1, lat2, lon2)
    return (
        f"if(isnull({lat1} + {lon1} + {lat2} + {lon2}), CAST(NULL AS DOUBLE), "
        f"{2 * EARTH_RADIUS_NM!r}D * asin(least(1D, sqrt({term}))))"
    )


def haversine_nm(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in nautical miles."""
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def haversine_atan2_nm(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """The same distance by the two-argument arctangent."""
    term = _half_chord(lat1, lon1, lat2, lon2)
    return F.expr(f"{2 * EARTH_RADIUS_NM!r}D * atan2(sqrt({term}), sqrt(greatest(0D, 1 - {term})))")


def bearing_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    east = f"sin(radians({lon2} - {lon1})) * cos(radians({lat2}))"
    north = (
        f"cos(radians({lat1})) * sin(radians({lat2}))"
        f" - sin(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2} - {lon1}))"
    )
    return f"pmod(degrees(atan2({east}, {north})) + 360, 360D)"


def bearing_deg(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Initial bearing from point 1 to point 2, in [0, 360)."""
    return F.expr(bearing_sql(lat1, lon1, lat2, lon2))


def dead_reckoning(lat: str, lon: str, sog: str, heading: str, minutes: int) -> tuple[Column, Column]:
    """Position after ``minutes`` on a straight course, six decimals."""
    miles = f"({sog}) * ({minutes} / 60D)"
    return (
        F.expr(f"round(({lat}) + {miles} * cos(radians({heading})) / 60D, 6)"),
        F.expr(
            f"round(({lon}) + {miles} * sin(radians({heading})) / (60D * cos(radians({lat})) + 1e-9D), 6)"
        ),
    )


def dead_reckoning_display(lat: str, lon: str, sog: str, heading: str, minutes: int = 5) -> tuple[Column, Column]:
    """The map form: null below 0.1 knots, no guard term, not rounded."""
    miles = f"({sog}) * ({minutes} / 60D)"
    return (
        F.expr(f"CASE WHEN {sog} >= 0.1D THEN ({lat}) + {miles} * cos(radians({heading})) / 60D END"),
        F.expr(
            f"CASE WHEN {sog} >= 0.1D THEN ({lon}) + {miles} * sin(radians({heading}))"
            f" / (60D * cos(radians({lat}))) END"
        ),
    )


def turn_wrapped(now: str, before: str) -> Column:
    """Absolute heading change on the circle, 0 to 180."""
    raw = f"abs(({now}) - ({before}))"
    return F.expr(f"CASE WHEN {raw} > 180 THEN 360 - {raw} ELSE {raw} END")


def turn_signed(now: str, before: str) -> Column:
    """Signed heading change, folded once into [-180, 180]."""
    raw = f"(({now}) - ({before}))"
    return F.expr(f"CASE WHEN {raw} > 180 THEN {raw} - 360 WHEN {raw} < -180 THEN {raw} + 360 ELSE {raw} END")


def turn_modulo(delta: str) -> Column:
    """Absolute change of a heading difference by modulo arithmetic."""
    return F.expr(f"abs(pmod(({delta}) + 180, 360D) - 180)")
