"""Times the headline queries on one data folder and prints one JSON line.

The pipeline tables are built first, as their own timed steps; reports then read the stored tables, the
way the jobs run in production.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import checks.cases  # noqa: E402, F401
from checks.cases_streaming import all_messages  # noqa: E402
from checks.registry import QUERIES, Tables  # noqa: E402
from wakeline.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BUILD = ("reports", "bronze", "silver", "newest", "density", "alerts", "weather")
HEADLINE = (
    "prj_03_batch_gate", "prj_06_physical_validity", "prj_18_track", "prj_20_recent_alerts", "wn_01_previous_position",
    "wn_03_motion_features", "wn_06_forward_fill", "wn_07_latest_per_vessel", "wn_08_dedup_exact", "wn_11_future_position",
    "wn_14_batch_motion", "jn_01_near_misses", "jn_03_density_weather", "jn_04_top_risky_vessels", "jn_05_port_zone",
    "ag_01_traffic_density", "ag_03_training_density", "ag_04_daily_stats", "ag_06_dim_vessel", "ag_09_busiest_lanes",
    "ag_10_anomaly_trends", "ag_12_risk_events", "sl_03_quota_per_level", "ml_01_rule_anomalies", "dq_06_daily_metrics",
    "src_01_read_day_files", "snk_01_write_partitioned", "st_01_bronze_stream",
)


def main() -> None:
    spark = build_session(
        "wakeline-bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false", "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    tables = Tables(spark, SF_DIR)
    spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    for name in BUILD:
        start = time.perf_counter()
        getattr(tables, name)
        seconds[f"build_{name}"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    all_messages(tables)
    seconds["build_messages"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
