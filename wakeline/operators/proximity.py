"""Near misses between vessels: a distance self-join by grid cells sized to the search radius."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import COLLISION_KIND, DEFAULTS, EARTH_RADIUS_NM, Thresholds
from wakeline.functions import geo, labels
from wakeline.session import materialise

_MARGIN = 1.000001
_POLAR_EDGE = 89.9
BLOCK_VESSELS = 1000
SECTION_PAIRS = 500_000
MOST_RANGES = 1000


def _row_height(radius_nm: float) -> float:
    """Height in degrees of one radius, a hair wider."""
    return math.degrees(radius_nm / EARTH_RADIUS_NM) * _MARGIN


def _cells_in_row(row: str, radius_nm: float, radii: int = 1) -> str:
    """How many cells a row of latitude has, so that each is at least ``radii`` radii wide.

    The widest longitude gap of two points within the radius, both in this row or a neighbouring one, is
    taken at the latitude nearest a pole. A row close to a pole is a single cell.
    """
    height = _row_height(radius_nm) * radii
    half = math.sin(radius_nm / EARTH_RADIUS_NM / 2)
    edge = f"greatest(abs(({row} - 1) * {height!r}D), abs(({row} + 2) * {height!r}D))"
    width = (
        f"degrees(2 * asin(least(1D, {half!r}D / cos(radians(least({_POLAR_EDGE}D, {edge})))))) * {_MARGIN * radii!r}D"
    )
    return f"if({edge} >= {_POLAR_EDGE}D, 1L, greatest(CAST(floor(360D / ({width})) AS BIGINT), 1L))"


def _cell_in_row(lon: str, count: str) -> str:
    return f"pmod(CAST(floor(({lon} + 180D) / 360D * {count}) AS BIGINT), {count})"


def position_pairs(positions: DataFrame, radius_nm: float, slot: str | None = None, carried: str | None = None) -> DataFrame:
    """All unordered pairs of distinct positions closer than ``radius_nm``.

    ``positions`` has one row per distinct (lat, lon), or per (lat, lon, ``slot``): then positions meet that lie in
    the same slot of time or in neighbouring ones, and a pair has one row for each two slots. Column ``carried``
    comes along on both sides. A point is looked up in the cells that its radius reaches, the date line included, and among the
    points that are not north of it, so the candidates stay within a small factor of the pairs that are truly close. Without
    slots a cell is about one radius wide; with slots, which thin it out, a cell is two radii and two slots wide, so that
    fewer copies of a point travel.
    """
    radii = 2 if slot else 1
    height = _row_height(radius_nm) * radii
    placed = positions.withColumn("__y", F.expr(f"lat / {height!r}D"))
    more = [c for c in (slot, carried) if c]
    a, b = ([f"{c} AS {c}_{mark}" for c in ("lat", "lon", *more)] for mark in "ab")
    left = (
        placed.withColumn("__row", F.expr("CAST(floor(__y) AS BIGINT)")).withColumn("__n", F.expr(_cells_in_row("__row", radius_nm, radii)))
        .selectExpr(*a, "__row", f"{_cell_in_row('lon', '__n')} AS __cell")
    )
    reach = f"{1 / radii!r}D"
    right = (
        placed.selectExpr(*b, f"explode(sequence(CAST(floor(__y - {reach}) AS BIGINT), CAST(floor(__y) AS BIGINT))) AS __row")
        .withColumn("__n", F.expr(_cells_in_row("__row", radius_nm, radii)))
        .withColumn("__x", F.expr("(lon_b + 180D) / 360D * __n"))
        .selectExpr(
            *[f"{c}_b" for c in ("lat", "lon", *more)], "__row",
            f"explode(array_distinct(transform(sequence(CAST(floor(__x - {reach}) AS BIGINT), CAST(floor(__x + {reach}) AS BIGINT)), "
            "c -> pmod(c, __n)))) AS __cell",
        )
    )
    if slot:  # an equality too, so that a cell that is busy all day is dealt out by time
        left = left.withColumn("__slot", F.expr(f"{slot}_a div 2"))
        right = right.withColumn("__slot", F.explode(F.expr(f"sequence(({slot}_b - 1) div 2, ({slot}_b + 1) div 2)")))
    return (
        left.join(right, ["__row", "__cell", *(["__slot"] if slot else [])])
        .filter("lat_a < lat_b OR (lat_a = lat_b AND lon_a < lon_b)").filter(f"abs({slot}_a - {slot}_b) <= 1" if slot else "true")
        .withColumn("dist", geo.haversine_nm("lat_a", "lon_a", "lat_b", "lon_b"))
        .filter(f"dist > 0 AND dist < {radius_nm}D")
        .select("lat_a", "lon_a", "lat_b", "lon_b", *[f"{c}_{mark}" for c in more for mark in "ab"])
    )


def near_misses(latest: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Pairs of moving vessels whose latest positions are within the near-miss radius.

    ``latest`` is the stored table with one row per vessel; it is read once for each side of the joins.
    The search runs over distinct positions; vessels are attached afterwards. A position shared by very
    many vessels (a default coordinate, say) is therefore one point of the search and its vessels are
    never compared with each other; they are at distance zero, which is no near miss. Where two such positions
    are close, every vessel of one meets every vessel of the other: their vessels are dealt to blocks of about
    ``BLOCK_VESSELS``, and each two blocks meet on their own, so that no task holds all pairs of two positions. The
    number of tasks is that of the session's shuffles: few bytes of vessels make many pairs, so it must not follow the bytes.

    Vessel 1 is the one with the smaller mmsi; the pair converges when its heading (north if unknown) is
    within the limit of the bearing to vessel 2.
    """
    moving = latest.filter(F.col("sog") >= t.near_miss_min_sog).select(
        "mmsi", "vessel_name", "event_id", "lat", "lon", "heading", "base_datetime"
    )
    spots = moving.groupBy("lat", "lon").agg(F.ceil(F.count("*") / BLOCK_VESSELS).alias("blocks"))
    block = F.pmod(F.xxhash64("mmsi", "event_id"), F.col("blocks"))
    dealt = moving.join(spots, ["lat", "lon"]).withColumn("block", block)
    meetings = position_pairs(spots.select("lat", "lon"), t.near_miss_nm)
    for mark in ("a", "b"):
        blocks = spots.selectExpr(
            f"lat AS lat_{mark}", f"lon AS lon_{mark}", f"explode(sequence(0L, blocks - 1)) AS block_{mark}")
        meetings = meetings.join(blocks, [f"lat_{mark}", f"lon_{mark}"])

    tasks = int(latest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(mark: str) -> DataFrame:
        place = [f"lat_{mark}", f"lon_{mark}", f"block_{mark}"]
        vessels = dealt.selectExpr(
            f"lat AS lat_{mark}", f"lon AS lon_{mark}", f"block AS block_{mark}",
            f"struct({', '.join(moving.columns)}) AS v_{mark}"
        )
        return meetings.join(vessels, place).repartition(tasks, *meetings.columns)

    found = side("a").join(side("b"), meetings.columns).filter("v_a.mmsi <> v_b.mmsi")
    return _described(found, t)


def near_misses_in_order(latest: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The rows of ``near_misses``, dealt to partitions in descending order of severity and then of ``detected_at``.

    A partition is one severity and one range of time, so a consumer that wants the rows in this order sorts each
    partition on its own. The pairs, whose number may grow with the square of the vessels in one place, are neither
    sampled nor shuffled for it: vessels travel to the partition in which they are the later one of a pair, once for each
    position near their own, and to those in which a vessel beside them is the later one. The ranges come from the times of the vessels and
    the number of pairs, which is counted by position; each has about ``SECTION_PAIRS`` pairs, and there are at most
    ``MOST_RANGES``. Equal times share a range.

    Distance and bearings belong to two positions and are computed once for these.
    """
    moving = latest.filter(F.col("sog") >= t.near_miss_min_sog).select(
        "mmsi", "vessel_name", "event_id", "lat", "lon", "heading", "base_datetime"
    ).withColumn("at", F.coalesce(F.unix_micros(F.col("base_datetime").cast("timestamp")), F.lit(-(2**63))))
    spots = moving.groupBy("lat", "lon").agg(F.count("*").alias("n"))
    either = F.explode(F.array(F.struct(*[f"{c}_{m}" for m in "ab" for c in ("lat", "lon")]), F.struct(*[
        F.col(f"{c}_{m}").alias(f"{c}_{o}") for m, o in ("ba", "ab") for c in ("lat", "lon")])))
    near = materialise(position_pairs(spots, t.near_miss_nm, carried="n").select(either.alias("s"), F.col("n_a") * F.col("n_b")).toDF(
        "s", "pairs").select("s.*", "pairs"), "near-positions")
    placed = materialise(moving.join(near.selectExpr("lat_a AS lat", "lon_a AS lon").distinct(), ["lat", "lon"], "left_semi"), "near-vessels")
    pairs = near.agg(F.sum("pairs")).first()[0] or 0
    ranges = min(max(math.ceil(pairs / 2 / SECTION_PAIRS), 1), MOST_RANGES)
    # a vessel is the later one for all earlier vessels, so ranges of equal numbers of pairs hold fewer vessels the later they are
    shares = [math.sqrt(k / ranges) for k in range(1, ranges)]
    edges = sorted(set(placed.agg(F.percentile_approx("at", shares, 100_000)).first()[0] or [])) if shares else []
    ranges = len(edges) + 1
    found = F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < F.col("at"))) if edges else F.lit(0)
    placed = placed.withColumn("range", found)
    ends = [f"{c}_{m}" for m in "ab" for c in ("lat", "lon")]
    apart = near.drop("pairs").withColumns({
        "dist": geo.haversine_nm(*ends), "out": geo.bearing_deg(*ends), "back": geo.bearing_deg(*ends[2:], *ends[:2]),
        "text": F.expr(f"format_string('%.2f', {geo.haversine_sql(*ends)})"),
    })

    def section(kind: str, at: str) -> str:
        return f"CAST({kind} * {ranges} + {ranges} - 1 - {at} AS INT)"

    kinds = f"if(dist < {t.near_miss_nm / 2!r}D, array(0), array(1, 2))"
    later = placed.selectExpr("lat AS lat_a", "lon AS lon_a", "range", "mmsi", "vessel_name", "event_id", "heading", "base_datetime", "at", "lat", "lon")
    later = later.join(apart, ["lat_a", "lon_a"]).selectExpr("*", f"explode({kinds}) AS kind").selectExpr(
        f"{section('kind', 'range')} AS section", "kind", "lat_b", "lon_b", "dist", "out", "back", "text", "at", "base_datetime",
        "struct(mmsi, vessel_name, event_id, lat, lon, heading) AS v_a")
    needed = later.selectExpr("section", f"{ranges} - 1 - section % {ranges} AS upto", "lat_b", "lon_b").distinct()
    earlier = placed.withColumns({"lat_b": F.col("lat"), "lon_b": F.col("lon")}).join(needed, ["lat_b", "lon_b"]).filter("range <= upto").selectExpr(
        "section", "lat_b", "lon_b", "at AS at_b", "struct(mmsi, vessel_name, event_id, lat, lon, heading) AS v_b")
    met = later.repartitionById(3 * ranges, "section").join(
        earlier.repartitionById(3 * ranges, "section").hint("merge"), ["section", "lat_b", "lon_b"])
    met = met.filter("v_a.mmsi <> v_b.mmsi AND (at > at_b OR (at = at_b AND v_a.mmsi > v_b.mmsi))").selectExpr(
        "kind", "dist", "text", "base_datetime", "if(v_a.mmsi < v_b.mmsi, v_a, v_b) AS v1", "if(v_a.mmsi < v_b.mmsi, v_b, v_a) AS v2",
        "if(v_a.mmsi < v_b.mmsi, out, back) AS course")
    met = met.withColumn("converging", geo.turn_wrapped("coalesce(v1.heading, 0D)", "course") < t.converging_deg)
    return _rows(met.filter("kind = 0 OR converging = (kind = 1)"), t, "text", "base_datetime")


def _described(found: DataFrame, t: Thresholds) -> DataFrame:
    """Near-miss rows of the pairs ``v_a, v_b``."""
    ends = ("v1.lat", "v1.lon", "v2.lat", "v2.lon")
    return _rows(
        found.selectExpr("if(v_a.mmsi < v_b.mmsi, v_a, v_b) AS v1", "if(v_a.mmsi < v_b.mmsi, v_b, v_a) AS v2")
        .withColumns({
            "dist": geo.haversine_nm(*ends),
            "turn": geo.turn_wrapped("coalesce(v1.heading, 0D)", geo.bearing_sql(*ends)),
        })
        .withColumn("converging", F.col("turn") < t.converging_deg),
        t, "format_string('%.2f', dist)", "greatest(v1.base_datetime, v2.base_datetime)",
    )


def _rows(found: DataFrame, t: Thresholds, text: str, detected_at: str) -> DataFrame:
    """The columns of a near miss of ``v1, v2``, of which ``dist`` and ``converging`` are known; ``text`` is the distance in words."""
    return found.select(
        F.lit(COLLISION_KIND).alias("alert_type"),
        F.when(F.col("dist") < t.near_miss_nm / 2, "CRITICAL")
        .when(F.col("converging"), "HIGH").otherwise("MEDIUM").alias("severity"),
        F.col("v1.mmsi").alias("mmsi_1"), F.col("v2.mmsi").alias("mmsi_2"),
        F.col("v1.vessel_name").alias("vessel_name_1"), F.col("v2.vessel_name").alias("vessel_name_2"),
        F.col("v1.event_id").alias("event_id_1"), F.col("v2.event_id").alias("event_id_2"),
        F.round("dist", 3).alias("distance_nm"),
        "converging",
        F.expr("(v1.lat + v2.lat) / 2").alias("lat"),
        F.expr("(v1.lon + v2.lon) / 2").alias("lon"),
        labels.near_miss_text("v1.mmsi", "v2.mmsi", text, "converging").alias("description"),
        F.expr(detected_at).alias("detected_at"),
    )


def _alone(moving: DataFrame, by: str, slot: str) -> DataFrame:
    """Adds ``alone``: the vessel has no other report in the same slot of time or in a neighbouring one."""
    own = moving.groupBy(by, slot).agg(F.count("*").alias("n"))
    around = own.select(by, F.explode(F.sequence(F.col(slot) - 1, F.col(slot) + 1)).alias(slot), "n").groupBy(by, slot).agg(F.sum("n").alias("n"))
    return moving.join(around, [by, slot]).withColumn("alone", F.col("n") == 1).drop("n")


def near_reports(reports: DataFrame, seconds: int, fresh: str | None = None, t: Thresholds = DEFAULTS) -> DataFrame:
    """Near misses over time: reports of two moving vessels within the radius and at most ``seconds`` apart.

    One row for two vessels and the later time, of the closest pair of reports (then the earliest). Only pairs with a
    report where ``fresh`` holds are looked for, if that column is named. The search runs over distinct positions per
    slot of ``seconds``. Reports of one position and slot travel as one row, in blocks of about ``BLOCK_VESSELS``, to the
    cells their radius reaches, and their pairs come out of that join: what is shuffled before follows the reports.

    Where neither report has another one of its vessel within a slot, the two are the only pair of their vessels and
    time. Such pairs, most of them where vessels report seldom, are not shuffled again; the others are grouped. Distance
    and bearings belong to two positions and are computed once for these.
    """
    mark = F.lit(True) if fresh is None else F.col(fresh)
    moving = reports.filter(F.col("sog") >= t.near_miss_min_sog).dropna(subset=["mmsi", "lat", "lon", "base_datetime"]).select(
        "mmsi", "vessel_name", "event_id", "lat", "lon", "heading", "base_datetime", mark.alias("fresh"),
        F.unix_seconds(F.col("base_datetime").cast("timestamp")).alias("second"),
    ).withColumn("slot", F.floor(F.col("second") / seconds))
    moving = _alone(moving, "mmsi", "slot")
    place = ["lat", "lon", "slot"]
    blocks = F.ceil(F.count("*").over(Window.partitionBy(*place)) / BLOCK_VESSELS)
    vessels = F.struct("mmsi", "vessel_name", "event_id", "heading", "base_datetime", "fresh", "second", "alone")
    spots = moving.select(*place, vessels.alias("v"), F.pmod(F.xxhash64("mmsi", "event_id"), blocks).alias("block")).groupBy(
        *place, "block").agg(F.collect_list("v").alias("vs"))
    ends = [f"{c}_{m}" for m in "ab" for c in ("lat", "lon")]
    pairs = position_pairs(spots, t.near_miss_nm, "slot", "vs").withColumns({
        "dist": geo.haversine_nm(*ends), "out": geo.bearing_deg(*ends), "back": geo.bearing_deg(*ends[2:], *ends[:2]),
        "text": F.expr(f"format_string('%.2f', {geo.haversine_sql(*ends)})"),
    }).selectExpr("*", "filter(vs_a, v -> v.alone) AS one_a", "filter(vs_b, v -> v.alone) AS one_b", "filter(vs_b, v -> NOT v.alone) AS more_b")

    def met(some_a: str, some_b: str) -> DataFrame:
        # the outer form lets no filter on sizes down to the shuffles, which both branches share
        rows = pairs.selectExpr("*", f"explode_outer({some_a}) AS a").selectExpr("*", f"explode_outer({some_b}) AS b")
        rows = rows.filter(f"a.mmsi <> b.mmsi AND (a.fresh OR b.fresh) AND abs(a.second - b.second) <= {int(seconds)}").selectExpr(
            "struct(a.*, lat_a AS lat, lon_a AS lon) AS v_a", "struct(b.*, lat_b AS lat, lon_b AS lon) AS v_b", "dist", "out", "back", "text")
        return rows.selectExpr(
            "if(v_a.mmsi < v_b.mmsi, v_a, v_b) AS v1", "if(v_a.mmsi < v_b.mmsi, v_b, v_a) AS v2", "dist", "text",
            "if(v_a.mmsi < v_b.mmsi, out, back) AS course")

    single = met("one_a", "one_b")
    several = met("vs_a", "if(a.alone, more_b, vs_b)")
    later = F.greatest("v1.base_datetime", "v2.base_datetime")
    best = F.min_by(F.struct(*several.columns), F.struct("dist", "v1.event_id", "v2.event_id"))
    grouped = several.groupBy(F.col("v1.mmsi"), F.col("v2.mmsi"), later).agg(best.alias("best")).select("best.*")
    found = single.unionByName(grouped).withColumn("converging", geo.turn_wrapped("coalesce(v1.heading, 0D)", "course") < t.converging_deg)
    return _rows(found, t, "text", "greatest(v1.base_datetime, v2.base_datetime)")
