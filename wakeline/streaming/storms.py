"""Alert storms on a stream: one row when enough busy minutes have followed each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def storm_alerts(alerts: DataFrame, per_minute: int = 200, minutes: int = 3, delay: str = "10 minutes") -> DataFrame:
    """A row for each storm: its first minute, when it was certain, and the alerts up to then.

    A storm is a run of at least ``minutes`` minutes with more than ``per_minute`` alerts each, as in
    ``quality.checks.alert_bursts``. It is raised as soon as the watermark has passed its first ``minutes`` minutes,
    and once only, however long it lasts: a span of one minute more that has a quiet minute first and busy ones after it occurs
    once in a run. So no run is followed in state. Two stateful steps, both closed by the watermark: alerts by minute,
    then busy minutes by the ``minutes + 1`` spans they lie in. State is a row for each open minute and each open span.
    Alerts without a time are left out; those later than ``delay`` are not counted. Works on a table as well.
    """
    timed = alerts.select(F.col("created_at").cast("timestamp_ltz").alias("at")).withWatermark("at", delay)
    counted = timed.groupBy(F.window("at", "1 minute").alias("of")).agg(F.count("*").alias("alerts"))
    busy = counted.filter(F.col("alerts") > per_minute).withColumn("minute", F.col("of.start"))
    span = F.window(F.window_time("of"), f"{minutes + 1} minutes", "1 minute").alias("span")
    spans = busy.groupBy(span).agg(F.count("*").alias("busy"), F.min("minute").alias("first"), F.sum("alerts").alias("alerts"))
    opening = (F.col("busy") == minutes) & (F.col("first") > F.col("span.start"))
    return spans.filter(opening).select(
        F.col("first").cast("timestamp_ntz").alias("first_minute"),
        F.col("span.end").cast("timestamp_ntz").alias("certain_at"), "alerts",
    )
