"""Motion deltas of a stream: every report paired with the one before it, also when that came in an earlier batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.functions import geo
from wakeline.operators import merge, tracks
from wakeline.streaming.bronze import UNTIL_DONE, batch_path
from wakeline.streaming.state import BucketTable

FIELDS = ("base_datetime", "lat", "lon", "sog", "heading")
LAST_COLUMNS = "mmsi STRING, event_id BIGINT, base_datetime TIMESTAMP_NTZ, lat DOUBLE, lon DOUBLE, sog DOUBLE, heading DOUBLE"
MOTION_COLUMNS = (
    "event_id BIGINT, mmsi STRING, base_datetime TIMESTAMP_NTZ, sog_change DOUBLE, heading_change DOUBLE, "
    "time_delta_sec BIGINT, distance_nm DOUBLE"
)


def linked(reports: DataFrame, last: DataFrame) -> DataFrame:
    """Deltas of ``reports`` with the last ping of each vessel before them.

    A report that is not newer than its vessel's last ping is late: it has no predecessor, and none of the others is
    paired with it. Rows are windowed per vessel and day in event order, so a vessel with very many reports in a batch is
    sorted by Spark, on disk where need be, and never gathered in Python.
    """
    known = last.select("mmsi", F.col("base_datetime").alias("__last"))
    timed = reports.join(known, "mmsi", "left").withColumn("__late", F.coalesce(F.col("base_datetime") <= F.col("__last"), F.lit(False)))
    current = timed.filter("NOT __late").select("event_id", "mmsi", *FIELDS).withColumn("__old", F.lit(False))
    rows = current.unionByName(last.select("event_id", "mmsi", *FIELDS).withColumn("__old", F.lit(True)))
    paired = tracks.with_neighbour(rows, FIELDS, order=("base_datetime", "event_id")).filter("NOT __old")
    here = paired.select("event_id", "mmsi", *FIELDS, "prev")
    late = timed.filter("__late").select("event_id", "mmsi", *FIELDS, F.lit(None).cast(here.schema["prev"].dataType).alias("prev"))
    return here.unionByName(late).select(
        "event_id", "mmsi", "base_datetime", F.expr("sog - prev.sog").alias("sog_change"),
        geo.turn_wrapped("heading", "prev.heading").alias("heading_change"),
        F.expr("timestampdiff(SECOND, prev.base_datetime, base_datetime)").alias("time_delta_sec"),
        F.round(geo.haversine_nm("prev.lat", "prev.lon", "lat", "lon"), 4).alias("distance_nm"),
    )


class MotionLinker:
    """The body of ``foreachBatch``. The state is one ping a vessel, of which a batch reads and writes its buckets only."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.last, self.target = BucketTable(spark, f"{path}/last", LAST_COLUMNS, "mmsi"), f"{path}/motion"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        query = str(batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
        reports = batch.select("event_id", "mmsi", F.col("event_time").alias("base_datetime"), "lat", "lon", "sog", "heading")
        known = self.last.read_like(reports.select("mmsi"), query, batch_id)
        # a bucket also holds vessels that do not report in this batch
        known = known.join(reports.select("mmsi").distinct(), "mmsi", "left_semi")
        linked(reports, known).write.mode("overwrite").parquet(batch_path(self.target, batch, batch_id))
        newest = merge.last_per_key(reports, ("mmsi",), ("base_datetime", "event_id")).select(*(c.split()[0] for c in LAST_COLUMNS.split(", ")))
        later = {c: F.expr(f"if(fresh.base_datetime > old.base_datetime, fresh.{c}, old.{c})") for c in newest.columns if c != "mmsi"}
        self.last.merge(query, batch_id, newest, lambda old: merge.upsert(old, newest, ("mmsi",), on_match=later))


def start_motion(stream: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_DONE) -> StreamingQuery:
    """Deltas below ``path/motion``, a folder for each batch."""
    return (
        stream.writeStream.foreachBatch(MotionLinker(stream.sparkSession, path)).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def stored_motion(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOTION_COLUMNS).parquet(f"{path}/motion").drop("query_id", "batch_id")
