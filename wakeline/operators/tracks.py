"""Per-vessel time-series operators that never gather a whole vessel in one task.

A window over ``mmsi`` alone would place every ping of a vessel in one task, and one vessel may hold a
third of all rows. Here rows are windowed per *vessel-day*. Report times have whole seconds, so after
``dedup_exact`` a vessel-day holds at most 86 400 rows. What a row needs from other days travels in a
summary with one row per vessel-day, which is windowed per vessel (one row per calendar day) and joined
back on (mmsi, day), the key the big side is already partitioned by.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "mmsi"
TIME = "base_datetime"
DAY = "__day"


def _days(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date(TIME))


def _in_day(order: Sequence[str]):
    return Window.partitionBy(KEY, DAY).orderBy(*order)


def _over_days():
    return Window.partitionBy(KEY).orderBy(DAY)


def _packed(fields: Sequence[str]) -> Column:
    return F.struct(*[F.col(f) for f in fields])


def _whole_rows(df: DataFrame) -> Column:
    """An aggregate that looks at every column of ``df``.

    A summary that needs a few columns would otherwise be planned over its own, narrower deduplication and shuffle.
    With this in it, both branches read the same exchange, and Spark computes that once.
    """
    return F.max(F.xxhash64(*df.columns))


def _by_day(df: DataFrame) -> DataFrame:
    """The rows, shuffled to their vessel-days: the one exchange that rows and day summary both start from.

    They can share it if the rows keep their columns, so callers choose columns before an operator and not after it.
    """
    return _days(df).repartition(KEY, DAY)


def _day_summary(rows: DataFrame, *figures: Column) -> DataFrame:
    """One row per vessel-day of rows from :func:`_by_day`, without another shuffle of them.

    The keys to join on are figures as well: what a join demands of its keys would else be pushed down into this branch,
    which then could not read the exchange of the rows.
    """
    return rows.groupBy(KEY, DAY).agg(
        *figures, F.max(KEY).alias("__key"), F.max(DAY).alias("__of"), _whole_rows(rows).alias("__rows"))


def _carried(summary: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """The columns to join to the rows on vessel and day."""
    return (
        summary.withColumns(values).filter("__rows IS NOT NULL")
        .select(F.col("__key").alias(KEY), F.col("__of").alias(DAY), *values)
    )


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def dedup_exact(df: DataFrame, order: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per (mmsi, base_datetime), the first by ``order``.

    ``row_number() = 1`` is planned with a group limit before the exchange, so copies of one ping are
    reduced to a single row per map task before they travel.
    """
    w = Window.partitionBy(KEY, TIME).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_minute(df: DataFrame) -> DataFrame:
    """Rows at the first report time within each vessel-minute, ties kept.

    The first time per minute is a small pre-aggregated table; the rows are then kept by an equi-join
    on the exact time, which adaptive execution splits when one key is hot.
    """
    first = (
        df.groupBy(KEY, F.date_trunc("minute", TIME).alias("__minute"))
        .agg(F.min(TIME).alias(TIME))
        .select(KEY, TIME)
    )
    return df.join(first, [KEY, TIME], "left_semi")


def latest_per_vessel(df: DataFrame, order: Sequence[str] = (TIME, "event_id")) -> DataFrame:
    """The newest row of each vessel (group limit before the exchange, as in ``dedup_exact``)."""
    w = Window.partitionBy(KEY).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def with_neighbour(
    df: DataFrame, fields: Sequence[str], name: str = "prev", ahead: bool = False,
    order: Sequence[str] = (TIME,),
) -> DataFrame:
    """Adds struct ``name`` with ``fields`` of the previous (or next) row of the same vessel."""
    rows = _by_day(df)
    packed = _packed(fields)
    step = F.lead if ahead else F.lag
    edge = F.min_by if ahead else F.max_by
    edges = _day_summary(rows, edge(packed, _order_key(order)).alias("__edge"))
    carry = _carried(edges, {"__carry": step("__edge", 1).over(_over_days())})
    return (
        rows.withColumn(name, step(packed, 1).over(_in_day(order)))
        .join(carry, [KEY, DAY], "left")
        .withColumn(name, F.coalesce(name, "__carry"))
        .drop("__carry", DAY)
    )


def with_row_ahead(
    df: DataFrame, fields: Sequence[str], steps: int, name: str = "ahead", order: Sequence[str] = (TIME,),
) -> DataFrame:
    """Adds struct ``name`` with ``fields`` of the row ``steps`` further on the same track, else null."""
    return with_rows_ahead(df, fields, {name: steps}, order)


def with_rows_ahead(
    df: DataFrame, fields: Sequence[str], steps: Mapping[str, int], order: Sequence[str] = (TIME,),
) -> DataFrame:
    """Adds a struct with ``fields`` of the row so many ``steps`` further on the same track for each name, else null.

    Within a day these are plain ``lead``s. The last rows of a day look past midnight: the day summary holds the
    first rows of each day, as many as the longest step, and from them the rows that follow each day. As no listed
    day is empty, at most that many later days are needed. All steps share one window and one summary.
    """
    packed, most = _packed(fields), max(steps.values())
    w = _in_day(order)
    rows = _days(df)
    heads = (
        rows.select(KEY, DAY, packed.alias("__f"), F.row_number().over(w).alias("__rn"))
        .filter(F.col("__rn") <= most)
        .groupBy(KEY, DAY).agg(F.array_sort(F.collect_list(F.struct("__rn", "__f"))).alias("__head"))
    )
    later = _over_days().rowsBetween(1, most)
    carry = heads.select(
        KEY, DAY,
        F.slice(F.flatten(F.collect_list(F.col("__head.__f")).over(later)), 1, most).alias("__following"),
    ).hint("merge")  # arrays are larger than Spark takes them for: the driver would hold them all
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def found(name: str, n: int) -> Column:
        beyond = F.col("__rn") + n - F.col("__n")
        return F.when(beyond <= 0, F.col(name)).otherwise(F.try_element_at("__following", beyond.cast("int")))

    return (
        rows.withColumns({
            **{name: F.lead(packed, n).over(w) for name, n in steps.items()},
            "__rn": F.row_number().over(w), "__n": F.count(F.lit(1)).over(whole),
        })
        .join(carry, [KEY, DAY], "left")
        .withColumns({name: found(name, n) for name, n in steps.items()})
        .drop("__rn", "__n", "__following", DAY)
    )


def forward_fill(df: DataFrame, columns: Sequence[str], order: Sequence[str] = (TIME,)) -> DataFrame:
    """Each null takes the last known value of the same vessel."""
    rows = _by_day(df)
    key = _order_key(order)
    known = _day_summary(rows, *[F.max_by(c, F.when(F.col(c).isNotNull(), key)).alias(f"__end_{c}") for c in columns])
    earlier = _over_days().rowsBetween(Window.unboundedPreceding, -1)
    carry = _carried(known, {f"__carry_{c}": F.last(f"__end_{c}", ignorenulls=True).over(earlier) for c in columns})
    running = _in_day(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.select(
        *[c for c in rows.columns if c not in columns],
        *[F.last(c, ignorenulls=True).over(running).alias(c) for c in columns],
    ).join(carry, [KEY, DAY], "left")
    return filled.select(
        *[F.coalesce(c, f"__carry_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def fill_first_known(df: DataFrame, columns: Sequence[str], order: Sequence[str] = (TIME,)) -> DataFrame:
    """Each null takes the first known value of the same vessel, wherever on the track it stands."""
    rows = _by_day(df)
    key = _order_key(order)
    known = _day_summary(rows, *[F.min_by(c, F.when(F.col(c).isNotNull(), key)).alias(f"__first_{c}") for c in columns])
    whole = _over_days().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = _carried(known, {f"__carry_{c}": F.first(f"__first_{c}", ignorenulls=True).over(whole) for c in columns})
    return rows.join(carry, [KEY, DAY], "left").select(
        *[F.coalesce(c, f"__carry_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def link_plausible(
    df: DataFrame,
    fields: Sequence[str],
    plausible: Callable[[str, str], Column],
    name: str = "prev",
    fill: Sequence[str] = (),
) -> DataFrame:
    """Drops rows that are implausible after their direct predecessor, then links the survivors.

    Nulls in the columns ``fill`` first take the vessel's first known value, from the same day summary.

    ``plausible(before, now)`` compares two struct columns of ``fields``, given by name. A vessel's first row always stays.
    Struct ``name`` of a surviving row holds ``fields`` of the previous *surviving* row. Both steps use
    one vessel-day window; the day summary carries the last row and the last survivor across midnight.
    """
    packed = _packed(fields)
    w = _in_day((TIME,))
    sofar = w.rowsBetween(Window.unboundedPreceding, -1)
    # the join below keeps no other rows; said here, it holds for both branches alike
    rows = (
        _days(df).filter(F.col(KEY).isNotNull() & F.col(DAY).isNotNull())
        .withColumn("__now", packed)
        .withColumn("__before", F.lag("__now", 1).over(w))
        .withColumn("__ok", F.when(F.col("__before").isNotNull(), plausible("__before", "__now")))
        .withColumn("__kept", F.last(F.when(F.col("__ok"), F.col("__now")), ignorenulls=True).over(sofar))
    )
    ends = rows.groupBy(KEY, DAY).agg(
        _whole_rows(df).alias("__rows"),
        F.min_by("__now", TIME).alias("first"),
        F.max_by("__now", TIME).alias("last"),
        F.max_by("__now", F.when(F.col("__ok"), F.col(TIME))).alias("kept"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(TIME))).alias(f"__first_{c}") for c in fill],
    )
    days = _over_days()
    whole = days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (
        ends.withColumn("before", F.lag("last", 1).over(days))
        .withColumn("first_ok", F.col("before").isNull() | plausible("before", "first"))
        .withColumn("end_kept", F.coalesce("kept", F.when(F.col("first_ok"), F.col("first"))))
        .withColumn(
            "kept_before",
            F.last("end_kept", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .filter("__rows IS NOT NULL")
        .select(
            KEY, DAY,
            F.col("first_ok").alias("__first_ok"),
            F.col("kept_before").alias("__kept_before"),
            F.when(F.col("first_ok"), F.col("first")).otherwise(F.col("kept_before")).alias("__kept_first"),
            *[F.first(f"__first_{c}", ignorenulls=True).over(whole).alias(f"__fill_{c}") for c in fill],
        )
    )
    opens_day = F.col("__before").isNull()
    return (
        rows.join(ends, [KEY, DAY])
        .filter(F.when(opens_day, F.col("__first_ok")).otherwise(F.col("__ok")))
        .withColumn(
            name,
            F.when(opens_day, F.col("__kept_before")).otherwise(F.coalesce("__kept", "__kept_first")),
        )
        .select(
            *[F.coalesce(c, f"__fill_{c}").alias(c) if c in fill else F.col(c) for c in df.columns], name
        )
    )
