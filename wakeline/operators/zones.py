"""Points in named rectangles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.config import PORT_BOXES, Box

BROADCAST_ROWS = 10_000


def box_table(spark: SparkSession, boxes: Sequence[Box] = PORT_BOXES) -> DataFrame:
    return spark.createDataFrame(
        [(b.name, b.lat_min, b.lat_max, b.lon_min, b.lon_max) for b in boxes],
        "zone string, lat_min double, lat_max double, lon_min double, lon_max double",
    )


def with_zone(points: DataFrame, boxes: Sequence[Box] = PORT_BOXES, cell_deg: float = 1.0) -> DataFrame:
    """Adds one row per box that holds the point, or a null zone when none does.

    The boxes are laid out over the whole-degree cells they touch, so the join is an equi-join on the cell
    and a range test inside it; it never compares every point with every box. The box list comes from the
    driver: up to ``BROADCAST_ROWS`` box-cells it is broadcast, beyond that it is shuffled.
    """
    spark = points.sparkSession

    def span(low: str, high: str):
        return F.sequence(F.floor(F.col(low) / cell_deg).cast("bigint"), F.floor(F.col(high) / cell_deg).cast("bigint"))

    cells = (
        box_table(spark, boxes)
        .withColumn("__y", F.explode(span("lat_min", "lat_max")))
        .withColumn("__x", F.explode(span("lon_min", "lon_max")))
    )
    spread = sum(
        (int((b.lat_max - b.lat_min) // cell_deg) + 2) * (int((b.lon_max - b.lon_min) // cell_deg) + 2) for b in boxes
    )
    if spread <= BROADCAST_ROWS:
        cells = F.broadcast(cells)
    p = points.withColumns({
        "__py": F.floor(F.col("lat") / cell_deg).cast("bigint"),
        "__px": F.floor(F.col("lon") / cell_deg).cast("bigint"),
    })
    hit = (
        (F.col("__py") == F.col("__y")) & (F.col("__px") == F.col("__x"))
        & F.col("lat").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("lon").between(F.col("lon_min"), F.col("lon_max"))
    )
    return p.join(cells, hit, "left").drop("__py", "__px", "__y", "__x", "lat_min", "lat_max", "lon_min", "lon_max")
