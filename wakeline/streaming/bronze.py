"""Message stream to Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wakeline.config import DEFAULTS, Thresholds
from wakeline.functions import cells
from wakeline.plans import bronze
from wakeline.streaming.sources import parse

NTZ = "timestamp_ntz"
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
UNTIL_DONE = {"availableNow": True}


def bronze_stream(raw: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Parsed, gated and enriched messages; cells are the decimal form rounded to one place."""
    rows = bronze.with_risk(bronze.speed_flags(bronze.batch_gate(parse(raw), t), t), t)
    return rows.withColumns({
        "event_time": F.col("base_datetime").try_cast("timestamp_ntz"),
        "ingestion_time": F.localtimestamp(),
        "lat_bin": F.round("lat", 1),
        "lon_bin": F.round("lon", 1),
    })


def batch_path(path: str, batch: DataFrame, batch_id: int) -> str:
    """The folder of one micro-batch. The query's id changes with its checkpoint, so a new start replaces nothing."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/query_id={query}/batch_id={batch_id}"


def append_batches(stream: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_TEN_SECONDS) -> StreamingQuery:
    """Micro-batch append. Each batch owns the folder of its query and number, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch, batch_id))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_direct(stream: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_DONE) -> StreamingQuery:
    """The file sink, exactly once by its own log. Continuous triggers are not possible with files."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path).trigger(**trigger).start()
    )


def _watermarked(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need the zoned timestamp type; callers turn the column back."""
    return stream.withColumn(column, F.col(column).cast("timestamp_ltz")).withWatermark(column, delay)


def without_repeats(stream: DataFrame, delay: str = "1 hour", keys: tuple[str, ...] = ("mmsi", "event_time")) -> DataFrame:
    """Each report once; state is kept only as long as a repeat may still arrive."""
    timed = _watermarked(stream, "event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).withColumn("event_time", F.col("event_time").cast(NTZ))


def hourly_density(stream: DataFrame, delay: str = "1 hour", width: float = 0.1) -> DataFrame:
    """Reports, vessels and mean speed per cell and hour, emitted when the hour is complete.

    Two stateful steps, each closed by the watermark: what a vessel did in a cell and hour, then the cells. So vessels are
    counted exactly, with one state row for each vessel, cell and open hour.
    """
    timed = _watermarked(stream.withColumn("at", F.col("event_time")), "at", delay)
    hour = F.window("at", "1 hour").alias("hour")
    cell = [cells.index("lat", width).alias("lat_cell"), cells.index("lon", width).alias("lon_cell")]
    vessels = timed.groupBy(hour, *cell, "mmsi").agg(
        F.count("*").alias("reports"),
        F.sum(F.expr("CAST(rint(sog * 10000D) AS BIGINT)")).alias("sog_units"),
        F.count_if(F.col("sog") < DEFAULTS.stopped_kn).alias("stopped"),
    )
    again = F.window(F.window_time("hour"), "1 hour").alias("hour")
    return (
        vessels.groupBy(again, "lat_cell", "lon_cell")
        .agg(
            F.sum("reports").alias("vessel_count"), F.count("*").alias("unique_vessels"),
            F.sum("sog_units").alias("sog_units"), F.sum("stopped").alias("stopped_count"),
        )
        .select(
            F.col("hour.start").cast(NTZ).alias("hour_bucket"), "lat_cell", "lon_cell", "vessel_count",
            "unique_vessels", F.expr("sog_units / (vessel_count * 10000D)").alias("avg_sog"), "stopped_count",
        )
    )


def new_critical(alerts: DataFrame, delay: str = "1 day") -> DataFrame:
    """CRITICAL alerts the first time their id is seen."""
    timed = _watermarked(alerts.filter("severity = 'CRITICAL'"), "created_at", delay)
    return timed.dropDuplicatesWithinWatermark(["id"]).withColumn("created_at", F.col("created_at").cast(NTZ))


PROGRESS_COLUMNS = (
    "query_id string, run_id string, batch_id long, at string, input_rows long, rows_per_second double, end_offset string"
)


class ProgressLog(StreamingQueryListener):
    """Appends a row for every finished batch of every query to a table; the query itself remembers the last 100 only."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rate = p.processedRowsPerSecond
        row = (
            str(p.id), str(p.runId), int(p.batchId), str(p.timestamp), int(p.numInputRows),
            float(rate) if rate == rate else 0.0, str([s.endOffset for s in p.sources]),
        )
        self.spark.createDataFrame([row], PROGRESS_COLUMNS).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """The batches a :class:`ProgressLog` has written."""
    return spark.read.schema(PROGRESS_COLUMNS).parquet(path)
