"""Quality rules as plain aggregates and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.operators import tracks
from wakeline.plans import silver


@dataclass(frozen=True)
class Expectation:
    """A row rule that must hold for at least the share ``mostly`` of the rows where it can be judged."""

    name: str
    rule: str
    mostly: float = 1.0


# --- Fixed values: the expectation suite of incoming reports -----------------------------------
SUITE = (
    Expectation("mmsi_nine_digits", "mmsi RLIKE '^[0-9]{9}$'", 0.99),
    Expectation("lat_in_range", "lat BETWEEN -90 AND 90", 0.999),
    Expectation("lon_in_range", "lon BETWEEN -180 AND 180", 0.999),
    Expectation("sog_in_range", "sog BETWEEN 0 AND 102", 0.999),
    Expectation("cog_in_range", "cog BETWEEN 0 AND 360", 0.999),
    Expectation("heading_in_range", "heading BETWEEN 0 AND 511", 0.999),
    Expectation("base_datetime_present", "base_datetime IS NOT NULL", 1.0),
    Expectation("not_null_island", "NOT (lat = 0 AND lon = 0)", 1.0),
)
DAILY_ROWS = (7_000_000, 11_000_000)
DAILY_VESSELS = (20_000, 50_000)


def run_suite(
    rows: DataFrame, suite: Sequence[Expectation] = SUITE, row_range: tuple[int, int] = DAILY_ROWS,
    vessel_range: tuple[int, int] = DAILY_VESSELS,
) -> DataFrame:
    """One verdict row per expectation, from a single pass over the data."""
    figures = rows.agg(
        F.count("*").cast("double").alias("row_count"), F.countDistinct("mmsi").cast("double").alias("vessel_count"),
        *[F.expr(f"try_divide(count_if({e.rule}), count({e.rule}))").alias(e.name) for e in suite],
    )
    tests = [(e.name, f"{e.name} >= {e.mostly}D") for e in suite] + [
        ("row_count", f"row_count BETWEEN {row_range[0]} AND {row_range[1]}"),
        ("vessel_count", f"vessel_count BETWEEN {vessel_range[0]} AND {vessel_range[1]}"),
    ]
    arms = ", ".join(
        f"struct('{name}' AS expectation, round({name}, 6) AS observed, coalesce({test}, false) AS passed)"
        for name, test in tests
    )
    return figures.select(F.expr(f"inline(array({arms}))"))


def mmsi_verdict(mmsi: str = "mmsi") -> Column:
    """'valid', or the reason why not: no digits, wrong length, unassigned country prefix."""
    text = f"trim(CAST({mmsi} AS STRING))"
    return F.expr(
        f"CASE WHEN {text} IS NULL OR NOT {text} RLIKE '^[0-9]+$' THEN 'non-numeric' "
        f"WHEN length({text}) <> 9 THEN concat('wrong_length_', length({text})) "
        f"WHEN substring({text}, 1, 3) < '201' OR (substring({text}, 1, 3) > '775' AND substring({text}, 1, 3) < '970') "
        "THEN 'invalid_mid_prefix' ELSE 'valid' END"
    )


def teleport_flags(rows: DataFrame, max_speed_kn: float = 50.0) -> DataFrame:
    """Adds ``teleport``: faster than the limit since the previous report, or no time between them."""
    linked = tracks.with_neighbour(rows, ("base_datetime", "lat", "lon"))
    seconds, distance = silver.step_seconds("prev"), silver.step_distance("prev")
    return linked.withColumns({"__s": seconds, "__d": distance}).withColumn(
        "teleport",
        F.coalesce((F.col("__s") <= 0) | (F.try_divide(F.col("__d") * 3600, F.col("__s")) > max_speed_kn), F.lit(False)),
    ).drop("prev", "__s", "__d")


def without_sentinels(rows: DataFrame) -> DataFrame:
    """'Not available' codes and zero dimensions as null."""
    codes = {
        "sog": C.SOG_NOT_AVAILABLE, "cog": C.COG_NOT_AVAILABLE, "heading": float(C.HEADING_NOT_AVAILABLE),
        "length": 0.0, "width": 0.0, "draft": 0.0,
    }
    return rows.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in codes.items() if c in rows.columns})


def daily_metrics(rows: DataFrame, as_of: Column) -> DataFrame:
    """Eight figures per day. Copies of a report are counted per (mmsi, time) before they meet."""
    bad = "coalesce(NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), true)"
    keyed = rows.groupBy("mmsi", "base_datetime").agg(
        F.count("*").alias("n"),
        F.count_if(F.expr(bad)).alias("bad"),
        F.count_if((F.col("lat") == 0) & (F.col("lon") == 0)).alias("island"),
        F.count_if(F.col("sog") == C.SOG_NOT_AVAILABLE).alias("sentinel"),
    )
    blank = F.expr("mmsi IS NULL OR trim(mmsi) = ''")
    share = lambda part: F.round(F.sum(part) * 100 / F.sum("n"), 4)
    return keyed.groupBy(F.to_date("base_datetime").alias("stat_date")).agg(
        F.sum("n").alias("row_count"),
        share(F.when(blank, F.col("n")).otherwise(0)).alias("null_mmsi_pct"),
        share("bad").alias("invalid_coords_pct"),
        share("island").alias("null_island_pct"),
        share("sentinel").alias("sentinel_sog_pct"),
        share(F.col("n") - 1).alias("duplicate_pct"),
        F.countDistinct("mmsi").alias("unique_vessel_count"),
        F.sum(F.when(F.col("base_datetime") > as_of, F.col("n")).otherwise(0)).alias("future_timestamp_count"),
    )


def triage(rows: DataFrame) -> DataFrame:
    """Adds ``action``: 'quarantine' for a bad key, 'drop' for an unusable position or time, else 'keep'."""
    unusable = (
        "coalesce(NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) OR lat = 0 OR lon = 0, true) "
        "OR base_datetime IS NULL"
    )
    return rows.withColumn(
        "action", F.when(mmsi_verdict() != "valid", "quarantine").when(F.expr(unusable), "drop").otherwise("keep")
    )


def split_quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to set aside)."""
    tagged = triage(rows)
    return tagged.filter("action = 'keep'").drop("action"), tagged.filter("action = 'quarantine'").drop("action")


def alert_bursts(alerts: DataFrame, per_minute: int = 200, minutes: int = 3) -> DataFrame:
    """Minutes with more alerts than the limit, marked when at least ``minutes`` of them follow each other.

    A storm is a span of ``minutes`` minutes that are all busy, midnight or not. Each busy minute counts for the spans
    it lies in, so no window orders all minutes.
    """
    minute = F.expr("CAST(date_trunc('minute', created_at) AS TIMESTAMP_NTZ)")
    busy = alerts.groupBy(minute.alias("minute")).agg(F.count("*").alias("alerts")).filter(F.col("alerts") > per_minute)
    placed = busy.withColumn("at", F.expr("unix_timestamp(minute) div 60"))
    spans = placed.select(F.explode(F.sequence(F.col("at") - (minutes - 1), "at")).alias("first")).groupBy("first").count()
    full = spans.filter(F.col("count") == minutes)
    storm = full.select(F.explode(F.sequence("first", F.col("first") + (minutes - 1))).alias("at")).distinct()
    return placed.join(storm.withColumn("storm", F.lit(True)), "at", "left").select(
        "minute", "alerts", F.coalesce("storm", F.lit(False)).alias("storm")
    )


def drift(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, limit: float = 0.2) -> DataFrame:
    """Population stability index per feature, over equal-width bins of the reference range.

    Both sides are reduced to ``features x bins`` counts before they are joined.
    """
    bounds = reference.agg(*[
        F.struct(F.min(f).cast("double").alias("lo"), F.max(f).cast("double").alias("hi")).alias(f) for f in features
    ]).first()
    usable = [f for f in features if bounds[f]["lo"] is not None and bounds[f]["hi"] > bounds[f]["lo"]]

    def histogram(df: DataFrame, name: str) -> DataFrame:
        arms = []
        for f in usable:
            lo, hi = bounds[f]["lo"], bounds[f]["hi"]
            place = f"least({bins}, greatest(1, CAST(floor((CAST({f} AS DOUBLE) - {lo!r}D) / {(hi - lo) / bins!r}D) AS INT) + 1))"
            arms.append(f"struct('{f}' AS feature, {place} AS bin)")
        long = df.select(F.expr(f"inline(array({', '.join(arms)}))")).filter("bin IS NOT NULL")
        counts = long.groupBy("feature", "bin").agg(F.count("*").alias("n"))
        totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
        return counts.join(totals, "feature").select("feature", "bin", (F.col("n") / F.col("total")).alias(name))

    both = histogram(reference, "p").join(histogram(current, "q"), ["feature", "bin"], "full_outer")
    p, q = (F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(1e-4)) for c in ("p", "q"))
    return both.groupBy("feature").agg(F.round(F.sum((q - p) * F.log(q / p)), 6).alias("psi")).withColumn(
        "drifted", F.col("psi") > limit
    )


def ks_distance(
    reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 1000, limit: float = 0.1,
) -> DataFrame:
    """Largest gap of the two cumulative shares per feature, taken at the edges of equal bins of the common range.

    Both sides are reduced to ``features x bins`` counts in one pass each, before they meet; a feature's running sums are
    over ``bins`` rows. Nulls are left out. A feature that one side lacks, or that is constant, has no row.
    """
    def span(df: DataFrame):
        return df.agg(*[F.struct(F.min(f).cast("double").alias("lo"), F.max(f).cast("double").alias("hi")).alias(f) for f in features]).first()

    one, two = span(reference), span(current)
    bounds = {
        f: (min(one[f]["lo"], two[f]["lo"]), max(one[f]["hi"], two[f]["hi"]))
        for f in features if one[f]["lo"] is not None and two[f]["lo"] is not None
    }
    arms = [
        f"struct('{f}' AS feature, least({bins}, CAST(floor((CAST({f} AS DOUBLE) - {lo!r}D) / {(hi - lo) / bins!r}D) AS INT) + 1) AS bin)"
        for f, (lo, hi) in bounds.items() if hi > lo
    ]
    if not arms:
        return reference.sparkSession.createDataFrame([], "feature string, ks double, drifted boolean")

    def counts(df: DataFrame, name: str) -> DataFrame:
        long = df.select(F.expr(f"inline(array({', '.join(arms)}))")).filter("bin IS NOT NULL")
        return long.groupBy("feature", "bin").agg(F.count("*").alias(name))

    both = counts(reference, "p").join(counts(current, "q"), ["feature", "bin"], "full_outer").fillna(0, ["p", "q"])
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(F.sum("p").over(upto) / F.sum("p").over(whole) - F.sum("q").over(upto) / F.sum("q").over(whole))
    return both.select("feature", gap.alias("gap")).groupBy("feature").agg(F.round(F.max("gap"), 6).alias("ks")).withColumn(
        "drifted", F.col("ks") > limit
    )


def drift_share(report: DataFrame, limit: float = 0.3) -> DataFrame:
    """The share of drifted features and whether it calls for training anew."""
    return report.agg(
        F.round(F.try_divide(F.count_if("drifted"), F.count("*")), 4).alias("share_drifted")
    ).withColumn("retrain", F.col("share_drifted") > limit)
