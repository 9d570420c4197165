"""Message streams and their parsing."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import cleaning

# --- Fixed values: the JSON message of one report ----------------------------------------------
MESSAGE_COLUMNS = """mmsi STRING, base_datetime STRING, lat DOUBLE, lon DOUBLE, sog DOUBLE, cog DOUBLE,
 heading DOUBLE, vessel_name STRING, imo STRING, call_sign STRING, vessel_type STRING, status STRING, length DOUBLE,
 width DOUBLE, draft DOUBLE, cargo STRING, transceiver_class STRING, data_split STRING"""
MAX_OFFSETS_PER_TRIGGER = 10_000


def kafka_options(servers: str, topic: str, starting: str = "earliest", sasl: bool = False) -> dict[str, str]:
    """Reader options; credentials come from the environment."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(MAX_OFFSETS_PER_TRIGGER),
    }
    if sasl:
        user, password = os.environ["KAFKA_USER"], os.environ["KAFKA_PASSWORD"]
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{user}" password="{password}";'
            ),
        }
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream with a ``value`` column. Needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of line-delimited JSON messages as a stream with a ``value`` column."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def replay_stream(spark: SparkSession, path: str, like: DataFrame, files_per_trigger: int = 1, split: str = "live") -> DataFrame:
    """A stored table as a stream, files in order, only the rows of one split."""
    table = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return table.filter(F.col("data_split") == split)


def parse(raw: DataFrame, columns: str = MESSAGE_COLUMNS) -> DataFrame:
    """The JSON value as columns with a report id; a value that is no JSON gives nulls and fails the quality gate."""
    return cleaning.with_report_id(raw.select(F.from_json("value", columns).alias("d")).select("d.*"))
