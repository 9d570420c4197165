"""The vessel-day operators against plain whole-vessel computations."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeline.operators import timesplit, tracks
from wakeline.plans import silver

START = datetime(2024, 1, 1, 22, 0, 0)
COLUMNS = "event_id long, mmsi string, base_datetime timestamp_ntz, lat double, lon double, sog double, heading double, name string"


def rows(seed: int, n: int = 240) -> list[tuple]:
    """Pings of three vessels over many days: dense hours, empty days, jumps, unknown values."""
    rng = random.Random(seed)
    out, event = [], 0
    for vessel in ("a", "b", "c"):
        at, lat, lon = START, 30.0, -80.0
        for _ in range(n // 3):
            at += timedelta(seconds=rng.choice([1, 30, 600, 7200, 100_000]))
            jump = rng.random() < 0.2
            lat += rng.uniform(-8, 8) if jump else rng.uniform(-0.01, 0.01)
            event += 1
            out.append((event, vessel, at, round(lat, 4), lon, rng.choice([None, 1.0, 9.5]), float(rng.randrange(360)),
                        rng.choice([None, None, f"name-{event}"])))
    return out


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    made = rows(request.param)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return spark.createDataFrame(made, COLUMNS), pd.DataFrame(made, columns=names).sort_values(["mmsi", "base_datetime"])


def values(df, *columns):
    return {r["event_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def plain(pdf, series):
    return {int(e): (None if pd.isna(v) else v,) for e, v in zip(pdf["event_id"], series, strict=True)}


def test_previous_and_next(data):
    df, pdf = data
    prev = tracks.with_neighbour(df, ("lat",)).select("event_id", F.col("prev.lat").alias("v"))
    after = tracks.with_neighbour(df, ("lat",), "next", ahead=True).select("event_id", F.col("next.lat").alias("v"))
    assert values(prev, "v") == plain(pdf, pdf.groupby("mmsi")["lat"].shift(1))
    assert values(after, "v") == plain(pdf, pdf.groupby("mmsi")["lat"].shift(-1))


@pytest.mark.parametrize("steps", [1, 5, 32])
def test_row_ahead_crosses_days(data, steps):
    df, pdf = data
    ahead = tracks.with_row_ahead(df, ("lat",), steps).select("event_id", F.col("ahead.lat").alias("v"))
    assert values(ahead, "v") == plain(pdf, pdf.groupby("mmsi")["lat"].shift(-steps))


def test_forward_fill(data):
    df, pdf = data
    assert values(tracks.forward_fill(df, ["name"]), "name") == plain(pdf, pdf.groupby("mmsi")["name"].ffill())


def test_fill_first_known(data):
    df, pdf = data
    first = pdf.groupby("mmsi")["name"].transform("first")
    assert values(tracks.fill_first_known(df, ["name"]), "name") == plain(pdf, pdf["name"].fillna(first))


def _haversine(a, b):
    import math

    p, q = math.radians(a[0]), math.radians(b[0])
    term = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return round(2 * 3440.065 * math.asin(math.sqrt(term)), 4)


def test_teleports_and_links_to_survivors(data):
    df, pdf = data
    expected = {}
    for _, track in pdf.groupby("mmsi"):
        before, kept = None, None
        for r in track.itertuples():
            if before is None:
                ok = True
            else:
                miles = _haversine((before.lat, before.lon), (r.lat, r.lon))
                seconds = (r.base_datetime - before.base_datetime).total_seconds()
                ok = miles / (seconds / 3600) <= 100
            if ok:
                expected[r.event_id] = (None if kept is None else kept.event_id,)
                kept = r
            before = r
    fields = ("event_id", *silver.MOTION_FIELDS)
    linked = tracks.link_plausible(df, fields, silver.no_teleport).select("event_id", F.col("prev.event_id").alias("p"))
    assert values(linked, "p") == expected
    assert len(expected) < len(pdf)


def test_zero_time_step_with_distance_is_dropped(spark):
    at = datetime(2024, 1, 1)
    made = [(1, "a", at, 10.0, 10.0, 1.0, 1.0, None), (2, "b", at, 10.0, 10.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(made, COLUMNS)
    same = df.withColumn("mmsi", F.lit("a")).withColumn("lat", F.col("lat") + F.col("event_id"))
    # two different rows at one time, as before deduplication
    speed = silver.implied_speed(F.lit(0.01), F.lit(0)).alias("s")
    assert same.select(speed).first()["s"] > 100
    assert same.select(silver.implied_speed(F.lit(0.0), F.lit(0)).alias("s")).first()["s"] == 0


def test_dedup_is_idempotent_and_keeps_the_first(spark, tables):
    once = tracks.dedup_exact(tables.reports)
    assert once.count() == tables.reports.select("mmsi", "base_datetime").distinct().count()
    assert tracks.dedup_exact(once).count() == once.count()


def test_silver_is_part_of_bronze_and_density_counts_it(tables):
    assert tables.silver.join(tables.bronze, ["event_id"], "left_anti").count() == 0
    assert tables.density.agg(F.sum("vessel_count")).first()[0] == tables.silver.count()


def test_cutoff_takes_the_share(spark):
    df = spark.range(1000).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 400) AS at")
    parts = timesplit.split_by_time(df, "at").groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 800, "test": 200}


def test_silver_reads_and_deduplicates_bronze_once(spark, tables):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the whole plan shows only without re-planning
    try:
        plan = silver.silver(tables.bronze)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert len([x for x in plan.split("\n") if " Exchange " in x]) <= 4


@pytest.mark.parametrize("operator", [
    lambda df: tracks.with_neighbour(df, ("lat", "lon")),
    lambda df: tracks.with_neighbour(df, ("lat",), "next", ahead=True),
    lambda df: tracks.forward_fill(df, ["vessel_name"]),
    lambda df: tracks.fill_first_known(df, ["vessel_name"]),
])
def test_rows_and_day_summary_share_one_exchange(spark, tables, operator):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = operator(tracks.dedup_exact(tables.bronze))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_rows_of_later_days_are_not_broadcast(tables):
    """The arrays that look past midnight stay on the executors, however small Spark takes them for."""
    ahead = tracks.with_rows_ahead(tables.silver, ("lat", "lon"), {"ahead": 10})
    assert "BroadcastHashJoin" not in ahead._jdf.queryExecution().executedPlan().toString()
