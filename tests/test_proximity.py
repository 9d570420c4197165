"""Near misses against a comparison of every pair, and the shape of the plan."""

import itertools
import math
import random
from datetime import datetime, timedelta

import pytest

from wakeline.config import Thresholds
from wakeline.operators import proximity, zones

LATEST = "mmsi string, vessel_name string, event_id long, lat double, lon double, sog double, heading double, base_datetime timestamp_ntz"


def miles(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    term = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 3440.065 * math.asin(min(1, math.sqrt(term)))


def cloud(seed):
    rng = random.Random(seed)
    spots = []
    for lat, lon in ((0, 0), (45, -70), (-60, 179.9995), (84.99, 10), (89.95, 0), (-89.99, 120), (29.7, -95)):
        for _ in range(25):
            spread = min(0.003 / max(math.cos(math.radians(lat)), 1e-3), 150)
            x = lon + rng.uniform(-spread, spread)
            spots.append((round(max(-90, min(90, lat + rng.uniform(-0.003, 0.003))), 5), round((x + 180) % 360 - 180, 5)))
    return sorted(set(spots))


@pytest.mark.parametrize("radius", [0.1, 0.5])
@pytest.mark.parametrize("seed", [3, 4])
def test_pairs_equal_brute_force_everywhere_on_the_globe(spark, seed, radius):
    spots = cloud(seed)
    expected = {
        (a, b) for a, b in itertools.combinations(spots, 2) if 0 < miles(a, b) < radius and abs(miles(a, b) - radius) > 1e-9
    }
    found = proximity.position_pairs(spark.createDataFrame(spots, "lat double, lon double"), radius).collect()
    pairs = [((r["lat_a"], r["lon_a"]), (r["lat_b"], r["lon_b"])) for r in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == expected
    assert len(expected) > 50


def latest(spark, made):
    at = datetime(2024, 1, 1)
    return spark.createDataFrame([(m, f"V{m}", i, lat, lon, sog, h, at) for i, (m, lat, lon, sog, h) in enumerate(made)], LATEST)


def test_severity_and_direction(spark):
    made = [("1", 10.0, 10.0, 5.0, 0.0), ("2", 10.0005, 10.0, 5.0, 0.0), ("3", 20.0, 10.0, 5.0, 0.0), ("4", 20.0013, 10.0, 5.0, 0.0),
            ("5", 30.0, 10.0, 5.0, 180.0), ("6", 30.0013, 10.0, 5.0, 0.0), ("7", 40.0, 10.0, 0.5, 0.0), ("8", 40.0005, 10.0, 5.0, 0.0)]
    found = {(r["mmsi_1"], r["mmsi_2"]): r for r in proximity.near_misses(latest(spark, made)).collect()}
    assert {k: r["severity"] for k, r in found.items()} == {("1", "2"): "CRITICAL", ("3", "4"): "HIGH", ("5", "6"): "MEDIUM"}
    assert found[("3", "4")]["description"] == "Vessels 3 and 4 are 0.08 nm apart and converging"


def test_one_position_shared_by_many_vessels(spark):
    """Vessels at one point are no near miss of each other, but each is one of the vessel beside them."""
    made = [(f"{i:04d}", 10.0, 10.0, 5.0, 0.0) for i in range(3000)] + [("9999", 10.0005, 10.0, 5.0, 0.0)]
    found = proximity.near_misses(latest(spark, made))
    assert found.count() == 3000


def test_no_pair_by_pair_plan(spark):
    plan = proximity.near_misses(latest(spark, [("1", 1.0, 1.0, 5.0, 0.0)]), Thresholds())._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_zone_edges(spark):
    points = spark.createDataFrame([(1, 29.5, -95.3), (2, 29.85, -94.8), (3, 29.49, -95.0), (4, 29.6, -90.0), (5, None, 1.0)], "id int, lat double, lon double")
    found = {r["id"]: r["zone"] for r in zones.with_zone(points).collect()}
    assert found == {1: "Houston Ship Channel", 2: "Houston Ship Channel", 3: None, 4: "Port of New Orleans", 5: None}


def test_two_crowded_places_are_dealt_to_tasks(spark, monkeypatch):
    """All vessels of one place meet all of the other: every pair once, and not in one task."""
    monkeypatch.setattr(proximity, "BLOCK_VESSELS", 10)
    made = [(f"{i:04d}", 10.0 + i % 2 * 0.0005, 10.0, 5.0, 0.0) for i in range(400)]
    found = proximity.near_misses(latest(spark, made))
    pairs = {(r["mmsi_1"], r["mmsi_2"]) for r in found.select("mmsi_1", "mmsi_2").collect()}
    assert pairs == {(a[0], b[0]) for a, b in itertools.combinations(made, 2) if a[1] != b[1]}
    assert found.count() == 200 * 200
    assert found.selectExpr("spark_partition_id() AS task").distinct().count() > 1


def live(spark, seed, spots, each):
    """Reports of moving vessels near each other, some vessels reporting often, some once; ``fresh`` in two of three."""
    rng, start, rows = random.Random(seed), datetime(2024, 1, 1), []
    for vessel in range(spots):
        lat, lon = rng.choice(((10.0, 179.9999), (-60.0, 30.0), (89.95, 0.0)))
        for _ in range(rng.choice((1, 1, each))):
            lon_now = round((lon + rng.randrange(3) * 0.0005 + 180) % 360 - 180, 4)
            at = start + timedelta(seconds=rng.randrange(1800))
            rows.append((f"{vessel:03d}", f"V{vessel}", len(rows), lat + rng.randrange(3) * 0.0005, lon_now, 5.0, 0.0, at, len(rows) % 3 > 0))
    return rows, spark.createDataFrame(rows, LATEST + ", fresh boolean")


@pytest.mark.parametrize("block", [2, 1000])
def test_near_reports_equal_every_pair(spark, monkeypatch, block):
    monkeypatch.setattr(proximity, "BLOCK_VESSELS", block)
    rows, reports = live(spark, 5, 120, 9)
    best = {}
    for x, y in itertools.combinations(rows, 2):
        x, y = sorted((x, y))
        apart = miles(x[3:5], y[3:5])
        if x[0] != y[0] and (x[8] or y[8]) and abs((x[7] - y[7]).total_seconds()) <= 300 and 0 < apart < Thresholds().near_miss_nm:
            key = x[0], y[0], max(x[7], y[7])
            best[key] = min(best.get(key, (9, 0, 0)), (round(apart, 9), x[2], y[2]))
    found = {(r["mmsi_1"], r["mmsi_2"], r["detected_at"]): r for r in proximity.near_reports(reports, 300, "fresh").collect()}
    assert found.keys() == best.keys() and len(best) > 200
    assert all(abs(found[k]["distance_nm"] - best[k][0]) < 1e-3 for k in best)


def test_pairs_of_lone_reports_are_not_shuffled(spark):
    """From the search to the rows there is no exchange where vessels report once."""
    _, reports = live(spark, 6, 10, 2)
    plan = proximity.near_reports(reports, 300)._jdf.queryExecution().executedPlan().toString().splitlines()
    above = plan[: next(i for i, line in enumerate(plan) if "Join [__row" in line)]
    assert not any("Exchange" in line or "Aggregate" in line for line in above)


def test_near_misses_in_order_are_the_same_rows_dealt_by_severity_and_time(spark, monkeypatch):
    monkeypatch.setattr(proximity, "SECTION_PAIRS", 50)
    rng, start = random.Random(7), datetime(2024, 1, 1)
    rows = []
    for vessel in range(150):
        lat, lon = rng.choice(((10.0, 179.9999), (-60.0, 30.0), (89.95, 0.0)))
        lon = round((lon + rng.randrange(3) * 0.0005 + 180) % 360 - 180, 4)
        at = None if vessel % 20 == 0 else start + timedelta(seconds=rng.randrange(40))
        heading = None if vessel % 7 == 0 else float(rng.randrange(360))
        rows.append((f"{vessel // 2 * 2 if vessel % 30 == 1 else vessel:03d}", f"V{vessel}", vessel, lat + rng.randrange(3) * 0.0007, lon, 5.0, heading, at))
    latest = spark.createDataFrame([*rows, rows[5], (None, "V", 200, 10.0, 179.9999, 5.0, 0.0, start)], LATEST)
    dealt = proximity.near_misses_in_order(latest)
    found = dealt.selectExpr("spark_partition_id() AS part", "*").collect()
    plain = proximity.near_misses(latest).collect()
    assert sorted(str(r[1:]) for r in found) == sorted(str(tuple(r)) for r in plain) and len(plain) > 500
    parts = {}
    for r in found:
        parts.setdefault(r["part"], []).append(r)
    assert all(len({r["severity"] for r in part}) == 1 for part in parts.values()) and len(parts) > 6
    rank = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2}
    age = lambda r: start - (r["detected_at"] or datetime(1970, 1, 1))
    spans = [(rank[part[0]["severity"]], min(map(age, part)), max(map(age, part))) for _, part in sorted(parts.items())]
    assert all(a[0] < b[0] or (a[0] == b[0] and a[2] < b[1]) for a, b in itertools.pairwise(spans))


def test_no_vessels_near_each_other(spark):
    assert proximity.near_misses_in_order(latest(spark, [("1", 1.0, 1.0, 5.0, 0.0), ("2", 2.0, 1.0, 5.0, 0.0)])).count() == 0


def test_open_collisions_are_ordered_without_a_shuffle_of_pairs(spark):
    import checks.cases  # noqa: F401
    from checks.registry import QUERIES

    found = QUERIES["prj_22_open_collisions"](spark, "/root/testdata/sf0.01")
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    above = plan[: next(i for i, line in enumerate(plan) if "SortMergeJoin [section" in line or "Join [lat_" in line)]
    assert not any("Exchange" in line for line in above)
    rows = found.collect()
    rank = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2}
    assert [r["id"] for r in rows] == [r["id"] for r in sorted(rows, key=lambda r: (rank[r["severity"]], datetime.max - r["created_at"], r["id"]))]
    assert len(rows) > 10
