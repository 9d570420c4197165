"""Formulas at their edges, against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from wakeline.functions import cells, cleaning, geo, labels
from wakeline.functions.aggregates import steady_avg


def one(spark, column, **values):
    row = ", ".join(f"{v} AS {k}" for k, v in values.items()) or "1 AS x"
    return spark.sql(f"SELECT {row}").select(column.alias("y")).first()["y"]


def test_one_degree_of_latitude(spark):
    expected = 3440.065 * math.radians(1)
    assert one(spark, geo.haversine_nm("0D", "0D", "1D", "0D")) == pytest.approx(expected)
    assert one(spark, geo.haversine_atan2_nm("0D", "0D", "1D", "0D")) == pytest.approx(expected)


def test_distance_of_antipodes_is_no_nan(spark):
    assert one(spark, geo.haversine_nm("0D", "0D", "0D", "180D")) == pytest.approx(math.pi * 3440.065)


def test_distance_to_unknown_is_null(spark):
    assert one(spark, geo.haversine_nm("a", "0D", "1D", "1D"), a="CAST(NULL AS DOUBLE)") is None


@pytest.mark.parametrize("lat2,lon2,expected", [(1, 0, 0), (0, 1, 90), (-1, 0, 180), (0, -1, 270)])
def test_bearing(spark, lat2, lon2, expected):
    assert one(spark, geo.bearing_deg("0D", "0D", f"{lat2}D", f"{lon2}D")) == pytest.approx(expected)


@pytest.mark.parametrize("now,before,wrapped,signed", [(10, 350, 20, 20), (350, 10, 20, -20), (180, 0, 180, 180), (90, 45, 45, 45)])
def test_turns(spark, now, before, wrapped, signed):
    assert one(spark, geo.turn_wrapped(f"{now}D", f"{before}D")) == wrapped
    assert one(spark, geo.turn_signed(f"{now}D", f"{before}D")) == signed
    assert one(spark, geo.turn_modulo(f"{now}D - {before}D")) == wrapped


def test_dead_reckoning_north(spark):
    lat, lon = geo.dead_reckoning("10D", "20D", "60D", "0D", 10)
    assert one(spark, lat) == pytest.approx(10 + 10 / 60, abs=1e-6)
    assert one(spark, lon) == 20.0
    assert one(spark, geo.dead_reckoning_display("10D", "20D", "0.05D", "0D")[0]) is None


@pytest.mark.parametrize("x,nearest,truncated,floor,half_even", [
    (0.25, 0.3, 0.2, 0.2, 0.2), (-0.25, -0.3, -0.2, -0.3, -0.2), (-0.04, 0.0, 0.0, -0.1, 0.0), (29.96, 30.0, 29.9, 29.9, 30.0),
])
def test_cells(spark, x, nearest, truncated, floor, half_even):
    for rule, expected in (("nearest", nearest), ("truncated", truncated), ("floor", floor), ("half_even", half_even)):
        assert one(spark, cells.coordinate("x", 0.1, rule), x=f"{x}D") == pytest.approx(expected), rule


@pytest.mark.parametrize("raw,expected", [("3.68E+08", "368000000"), ("368000000.0", "368000000"), (" 12 ", "12"), ("abc ", "abc"), ("NaN", "NaN")])
def test_repair_mmsi(spark, raw, expected):
    assert one(spark, cleaning.repair_mmsi("x"), x=f"'{raw}'") == expected


@pytest.mark.parametrize("raw,expected", [("1.5", 1.5), ("nan", 0.0), ("Infinity", 0.0), ("-Infinity", 0.0), ("x", 0.0), ("", 0.0)])
def test_safe_number(spark, raw, expected):
    assert one(spark, cleaning.safe_number("x"), x=f"'{raw}'") == expected


def test_times_that_do_not_parse_are_null(spark):
    assert one(spark, cleaning.report_time("x"), x="'2024-13-01 00:00:00'") is None
    assert one(spark, cleaning.iso_time("x"), x="'yesterday'") is None
    assert str(one(spark, cleaning.iso_time("x"), x="'2024-01-02T03:04:05Z'")) == "2024-01-02 03:04:05"


def test_unknown_speed_is_low_risk(spark):
    assert one(spark, labels.risk_level("x", "true"), x="CAST(NULL AS DOUBLE)") == "LOW"
    assert one(spark, labels.risk_level("0.4D", "true")) == "HIGH"
    assert one(spark, labels.risk_level("0.4D", "false")) == "MEDIUM"


def test_overlapping_regions_take_the_first_rule(spark):
    assert one(spark, labels.region("25D", "-81D")) == "East Coast"
    assert one(spark, labels.region("25D", "-90D")) == "Gulf of Mexico"
    assert one(spark, labels.region("45D", "-90D")) == "Great Lakes"
    assert one(spark, labels.region("45D", "-90D", with_lakes=False)) == "Other US Waters"


@pytest.mark.parametrize("wind,wave,expected", [("24.5D", "6D", 1.0), ("49D", "NULL", 1.0), ("NULL", "6D", 0.0), ("NULL", "NULL", 0.0), ("12.25D", "3D", 0.5)])
def test_weather_severity(spark, wind, wave, expected):
    values = {"w": f"CAST({wind} AS DOUBLE)", "v": f"CAST({wave} AS DOUBLE)"}
    assert one(spark, labels.weather_severity("w", "v"), **values) == pytest.approx(expected)


def test_steady_avg_is_exact_and_null_on_nothing(spark):
    df = spark.range(0, 1000).selectExpr("CAST(id % 3 AS DOUBLE) / 10 AS x")
    for parts in (1, 7):
        assert df.repartition(parts).agg(steady_avg("x").alias("a")).first()["a"] == 999 / 10000
    assert df.filter("x > 5").agg(steady_avg("x").alias("a")).first()["a"] is None


def test_vessel_type_fallbacks(spark):
    assert one(spark, labels.vessel_type_track("x"), x="'70.0'") == "Cargo"
    assert one(spark, labels.vessel_type_track("x"), x="'abc'") == "abc"
    assert one(spark, labels.vessel_type_ranges("x"), x="'75.0'") == "Cargo"
    assert one(spark, labels.vessel_type_shared("x"), x="'98'") == "Type 98"
    assert one(spark, labels.vessel_type_numeric("x"), x="'x'") == "Unknown"
    assert one(spark, F.coalesce(labels.vessel_type_screen("x"), F.lit("?")), x="'70.0'") == "Cargo"
