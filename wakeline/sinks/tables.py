"""Writing tables to shared storage."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import cells, cleaning, labels

DATE_PARTS = ("year", "month", "day")

# --- Fixed values: column lists of the stored tables -------------------------------------------
_REPORT = """mmsi STRING, base_datetime TIMESTAMP_NTZ, lat DOUBLE, lon DOUBLE, sog DOUBLE, cog DOUBLE,
 heading DOUBLE, vessel_name STRING, imo STRING, call_sign STRING, vessel_type STRING"""
TABLE_COLUMNS = {
    "bronze": _REPORT + """, status STRING, length DOUBLE, width DOUBLE, draft DOUBLE, cargo STRING,
 transceiver_class STRING, risk_level STRING, lat_bin DOUBLE, lon_bin DOUBLE, is_stopped BOOLEAN, is_slow BOOLEAN,
 is_speeding BOOLEAN, in_us_port_zone BOOLEAN, data_split STRING, event_time TIMESTAMP_NTZ,
 ingestion_time TIMESTAMP_NTZ, year INT, month INT, day INT, hour INT""",
    "silver": _REPORT + """, vessel_type_label STRING, status STRING, status_label STRING, length DOUBLE,
 width DOUBLE, draft DOUBLE, cargo STRING, transceiver_class STRING, risk_level STRING, lat_bin DOUBLE,
 lon_bin DOUBLE, lat_bin_fine DOUBLE, lon_bin_fine DOUBLE, is_stopped BOOLEAN, is_slow BOOLEAN, is_speeding BOOLEAN,
 in_us_port_zone BOOLEAN, sog_change DOUBLE, heading_change DOUBLE, time_delta_sec DOUBLE, distance_nm DOUBLE,
 data_split STRING, year INT, month INT, day INT, hour INT""",
    "vessel_latest": """mmsi STRING, vessel_name STRING, vessel_type STRING, lat DOUBLE, lon DOUBLE, sog DOUBLE,
 cog DOUBLE, heading DOUBLE, risk_level STRING, is_anomaly BOOLEAN, anomaly_score DOUBLE, anomaly_type STRING,
 predicted_lat DOUBLE, predicted_lon DOUBLE, base_datetime TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
 data_split STRING""",
    "traffic_density": """lat_bin DOUBLE, lon_bin DOUBLE, hour_bucket TIMESTAMP_NTZ, vessel_count INT,
 unique_vessels INT, avg_sog DOUBLE, stopped_count INT, congestion_level STRING, data_split STRING""",
    "anomalies": """mmsi STRING, vessel_name STRING, lat DOUBLE, lon DOUBLE, anomaly_type STRING,
 anomaly_score DOUBLE, sog DOUBLE, heading_change DOUBLE, risk_level STRING, base_datetime TIMESTAMP_NTZ,
 data_split STRING""",
    "daily_stats": """stat_date DATE, total_vessels INT, total_records BIGINT, avg_sog DOUBLE, max_sog DOUBLE,
 high_risk_count INT, anomaly_count INT, data_split STRING""",
}


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = DATE_PARTS) -> None:
    """Partitioned Parquet with well-filled files.

    The rebalance hint lets adaptive execution merge small partitions and split a large day over several
    tasks, so neither a day's size nor skew decides the file sizes.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """The whole table replaced, schema included."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] = DATE_PARTS) -> None:
    """Only the partitions that occur in ``df`` are replaced."""
    (
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def append_evolving(df: DataFrame, path: str) -> None:
    """Append; columns may come and go between appends."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows under the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def create_empty(spark: SparkSession, path: str, columns: str) -> None:
    """An empty typed table."""
    spark.createDataFrame([], columns).write.mode("overwrite").parquet(path)


def register(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Puts a stored table into the catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    return spark.table(table)


def rewrite_clustered(df: DataFrame, path: str, keys: Sequence[str] = ("mmsi", "base_datetime")) -> None:
    """Compacted and ordered by key ranges, so that Parquet statistics skip most files of a look-up."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def status_dimension(spark: SparkSession) -> DataFrame:
    """The navigation status table: 9 codes with their flags."""
    rows = [
        (int(code), code, C.STATUS_SHARED[code], *flags) for code, flags in C.STATUS_FLAGS.items()
    ]
    return spark.createDataFrame(
        rows,
        "status_id int, status_code string, status_label string, is_underway boolean, is_stopped boolean, "
        "is_anchored boolean, is_moored boolean, is_aground boolean",
    )


def sample_share(df: DataFrame, share: float, seed: int = 42, identity: Sequence[str] = ("mmsi", "base_datetime")) -> DataFrame:
    """A repeatable sample: rows whose seeded hash falls into the given share of 10 000 buckets."""
    bucket = F.pmod(F.xxhash64(*identity, F.lit(seed)), F.lit(10_000))
    return df.filter(bucket < int(share * 10_000))


def track_fact(
    rows: DataFrame, share: float | None = None, target_rows: int | None = None, seed: int = 42,
    ingested_at: Column | None = None,
) -> DataFrame:
    """The track table: train rows with defaults, cut to column widths.

    All of them, unless the caller asks for a ``share`` of them or for about ``target_rows``. The target is reached
    in whole hash buckets, so the load stays distributed: only the 10 000 bucket counts are ordered, never the rows.
    """
    from pyspark.sql import Window

    train = rows.filter(F.col("data_split") == "train")
    if share is not None:
        train = sample_share(train, share, seed)
    if target_rows is not None:
        bucket = F.pmod(F.xxhash64("mmsi", "base_datetime", F.lit(seed)), F.lit(10_000))
        counted = train.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        last = (
            counted.withColumn("before", F.coalesce(before, F.lit(0)))
            .filter(F.col("before") < target_rows).agg(F.max("bucket")).scalar()
        )
        train = train.filter(bucket <= last)
    have = set(rows.columns)

    def number(c: str) -> Column:
        return F.expr(f"coalesce(try_cast({c} AS DOUBLE), 0D)" if c in have else "0D").alias(c)

    def text(c: str, width: int, default: str = "") -> Column:
        return (cleaning.cut(c, width, default) if c in have else F.lit(default)).alias(c)

    shaped = train.select(
        F.trim("mmsi").alias("mmsi"),
        text("vessel_name", 100),
        F.substring(labels.vessel_type_track("vessel_type"), 1, 50).alias("vessel_type"),
        "lat", "lon",
        cells.coordinate("lat", 0.1, "half_even", 1).alias("lat_bin"),
        cells.coordinate("lon", 0.1, "half_even", 1).alias("lon_bin"),
        number("sog"), number("cog"), number("heading"),
        text("status", 20), text("risk_level", 10, "LOW"),
        (F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in have else F.lit(False)).alias("is_anomaly"),
        number("anomaly_score"), text("anomaly_type", 100),
        "base_datetime",
        (F.localtimestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.lit("train").alias("data_split"),
    )
    return shaped.dropna(subset=["mmsi", "base_datetime", "lat", "lon"]).filter("mmsi <> ''")


def retained(df: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Rows young enough to keep."""
    return df.filter(F.col("base_datetime") >= as_of - F.expr(f"make_dt_interval({int(days)}, 0, 0, 0)"))


def message_records(df: DataFrame) -> DataFrame:
    """Key and JSON value of a report, ready for ``write.format('kafka')``."""
    return df.select(F.col("mmsi").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def jdbc_options(url_var: str = "WAREHOUSE_JDBC_URL") -> dict[str, str]:
    """Connection options from the environment; nothing is stored in code."""
    names = {"url": url_var, "user": "WAREHOUSE_USER", "password": "WAREHOUSE_PASSWORD", "driver": "WAREHOUSE_DRIVER"}
    found = {option: os.environ[var] for option, var in names.items() if var in os.environ}
    if "url" not in found:
        raise RuntimeError(f"set {url_var} to the JDBC URL of the warehouse")
    return found


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """A table of the warehouse replaced over JDBC, written in parallel by the tasks."""
    df.write.format("jdbc").options(dbtable=table, **options).mode(mode).save()
