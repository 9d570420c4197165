"""Text, number and time repair. All casts are ``try_`` casts: bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import NULL_TOKENS, TIME_FORMAT

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def blank_to_null(x: str) -> Column:
    """Trimmed text, null when it is one of the usual spellings of 'nothing'."""
    return F.expr(f"CASE WHEN trim(CAST({x} AS STRING)) NOT IN ({_TOKENS}) THEN trim(CAST({x} AS STRING)) END")


def safe_number(x: str, default: float = 0.0) -> Column:
    """A finite double, else ``default``."""
    n = f"try_cast({x} AS DOUBLE)"
    return F.expr(f"CASE WHEN NOT isnan({n}) AND abs({n}) < CAST('Infinity' AS DOUBLE) THEN {n} ELSE {default}D END")


def repair_mmsi(x: str) -> Column:
    """'3.68E+08' and '368000000.0' become '368000000'; anything else is trimmed."""
    text = f"trim(CAST({x} AS STRING))"
    return F.expr(
        f"coalesce(CAST(try_cast(nullif(try_cast({text} AS DOUBLE), CAST('NaN' AS DOUBLE)) AS BIGINT) AS STRING),"
        f" {text})"
    )


def report_time(x: str) -> Column:
    """The file form of the report time, null when it does not parse."""
    return F.expr(f"CAST(try_to_timestamp(CAST({x} AS STRING), '{TIME_FORMAT}') AS TIMESTAMP_NTZ)")


def iso_time(x: str) -> Column:
    """ISO text with an optional 'Z' or '+hh:mm' that is cut off, null on failure."""
    return F.expr(rf"try_cast(regexp_replace({x}, '(Z|[+].*)$', '') AS TIMESTAMP_NTZ)")


def content_id(*parts: Column | str) -> Column:
    """A positive 60-bit number made of the row's own content, the same wherever and whenever it is computed.

    Parts are columns or their names. Nulls count as empty text.
    """
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("bigint")


#: What tells reports of one vessel and second apart.
REPORT_IDENTITY = ("mmsi", "base_datetime", "lat", "lon", "sog", "cog", "heading", "vessel_name", "status")


def with_report_id(df: DataFrame) -> DataFrame:
    """Adds ``event_id`` made of the report's own fields, unless the source brings one."""
    if "event_id" in df.columns:
        return df
    return df.withColumn("event_id", content_id(*[c for c in REPORT_IDENTITY if c in df.columns]))


def cut(x: str, width: int, default: str = "") -> Column:
    """Text with a default, cut to a column width."""
    return F.expr(f"substring(coalesce(CAST({x} AS STRING), '{default}'), 1, {width})")


def truncate_time(unit: str, x: str) -> Column:
    """``date_trunc`` that stays a zone-less timestamp."""
    return F.expr(f"CAST(date_trunc('{unit}', {x}) AS TIMESTAMP_NTZ)")


def seconds_between(later: str, earlier: str) -> Column:
    return F.expr(f"unix_timestamp({later}) - unix_timestamp({earlier})")
