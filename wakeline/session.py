"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wakeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; the cluster supplies sizes and paths."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only where nothing is configured (tests on one machine) a folder of its own is chosen.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "wakeline-checkpoints")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; every call returns another one."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches start from the same expensive rows. The written table survives the
    loss of executors, which cached blocks do not.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
