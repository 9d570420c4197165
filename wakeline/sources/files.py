"""Reading raw day files and stored tables, and turning raw fields into canonical reports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import cells, cleaning, labels
from wakeline.plans import bronze

SAMPLE_BUCKETS = 1 << 20
#: What a report cannot be without.
REQUIRED_FIELDS = ("mmsi", "base_datetime", "lat", "lon")


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The files of each header line, as text. One pass over the lines, which looks at the first block of each file only.

    What comes back is one name a file and one line a header; files without a line have neither.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    ).filter("block = 0 AND trim(value) <> ''")
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        found.setdefault(row["header"], []).append(row["file"])
    return found


def _as_path(uri: str) -> str:
    """A file's URI as a path for a reader, which takes some characters for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_days(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Raw CSV reports as text columns under their canonical names, with the name of the file.

    Every file is read by its own header: order, spelling and set of columns may differ from file to file, also within a
    folder. Files with equal headers are read together, so the plan has one scan for each form of header. A header
    without the columns no report can lack is an error that names the file.
    """
    parts = []
    for header, names in file_headers(spark, paths).items():
        csv = spark.read.option("header", True).option("enforceSchema", False).csv([_as_path(n) for n in names])
        part = resolve_headers(csv)
        if lacking := [c for c in REQUIRED_FIELDS if c not in part.columns]:
            raise ValueError(f"header of {names[0]} has no column for {', '.join(lacking)}: {header[:200]}")
        parts.append(part.withColumn("source_file", F.col("_metadata.file_name")))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} STRING" for c in (*REQUIRED_FIELDS, "source_file")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def resolve_headers(df: DataFrame) -> DataFrame:
    """Renames known header spellings (trimmed, any case) to canonical names; the first alias present wins."""
    present = {c.strip().lower(): c for c in df.columns}
    renames: dict[str, str] = {}
    for canonical, aliases in C.HEADER_ALIASES.items():
        if canonical in df.columns:
            continue
        found = next((present[a] for a in aliases if a in present and present[a] not in renames), None)
        if found:
            renames[found] = canonical
    return df.withColumnsRenamed(renames)


def header_version(columns: Sequence[str]) -> str:
    """Which generation of the file format a header belongs to."""
    names = {c.strip().lower() for c in columns}
    if not names & {"transceiver_class", "transceiver"}:
        return "v1"
    return "v3" if "heading" in names else "v2"


def normalise_record(df: DataFrame) -> DataFrame:
    """Canonical report fields from whatever alias columns exist.

    Of several aliases the first non-empty one counts, row by row. Missing numbers become 0, missing text ''.
    """
    present = {c.strip().lower(): c for c in df.columns}

    def pick(canonical: str) -> str:
        found = [f"`{present[a]}`" for a in C.HEADER_ALIASES[canonical] if a in present]
        tokens = ", ".join(f"'{t}'" for t in C.NULL_TOKENS)
        parts = [f"CASE WHEN trim(CAST({c} AS STRING)) NOT IN ({tokens}) THEN CAST({c} AS STRING) END" for c in found]
        return f"coalesce({', '.join(parts)})" if parts else "CAST(NULL AS STRING)"

    picked = df.selectExpr(*[f"{pick(c)} AS {c}" for c in C.HEADER_ALIASES])
    return picked.select(
        F.coalesce(cleaning.repair_mmsi("mmsi"), F.lit("")).alias("mmsi"),
        F.expr("coalesce(trim(base_datetime), '')").alias("base_datetime"),
        *[cleaning.safe_number(c).alias(c) for c in C.NUMBER_FIELDS],
        *[F.expr(f"coalesce(trim({c}), '')").alias(c) for c in C.TEXT_FIELDS],
    )


def ingest(raw: DataFrame, blank_as_null: bool = True) -> DataFrame:
    """Typed, gated reports from raw text columns under canonical names, with an id if the files have none.

    With ``blank_as_null`` a missing field stays null, so that later steps can fill it and an unknown
    speed does not count as standing still. Without it numbers become 0 and texts ''.
    """
    have = set(raw.columns)

    def number(c: str) -> Column:
        if not blank_as_null:
            return cleaning.safe_number(c).alias(c)
        return F.nullif(cleaning.safe_number(c, float("1e300")), F.lit(1e300)).alias(c)

    def text(c: str) -> Column:
        if c not in have:
            return F.lit(None if blank_as_null else "").cast("string").alias(c)
        return (cleaning.blank_to_null(c) if blank_as_null else F.expr(f"coalesce(trim({c}), '')")).alias(c)

    typed = raw.select(
        cleaning.repair_mmsi("mmsi").alias("mmsi"),
        cleaning.report_time("base_datetime").alias("base_datetime"),
        *[number(c) for c in C.NUMBER_FIELDS if c in have],
        *[text(c) for c in C.TEXT_FIELDS],
        *[c for c in raw.columns if c not in C.HEADER_ALIASES],
    )
    speed = "sog BETWEEN 0 AND 60" + (" OR sog IS NULL" if blank_as_null else "")
    return cleaning.with_report_id(typed).filter(
        F.col("base_datetime").isNotNull() & bronze.valid_position()
        & F.expr(f"mmsi NOT IN ('', 'nan') AND ({speed})")
    )


def with_ingest_columns(reports: DataFrame) -> DataFrame:
    """Date parts, legacy risk and truncated cells of the landed files."""
    at = F.col("base_datetime")
    return reports.withColumns({
        "year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at),
        "risk_level": labels.risk_level_legacy("sog", "lat", "lon"),
        "lat_bin": cells.coordinate("lat", 0.1, "truncated"),
        "lon_bin": cells.coordinate("lon", 0.1, "truncated"),
    })


def split_by_file(df: DataFrame, file: str = "source_file") -> DataFrame:
    """data_split by the position of the file in name order: 71 % train, up to 86 % test, then live.

    Positions are computed over the distinct file names, one row a file, in one step, and joined back.
    """
    from pyspark.sql import Window

    names = df.select(file).distinct()
    place, n = F.row_number().over(Window.orderBy(file)) - 1, F.count("*").over(Window.partitionBy(F.lit(0)))
    placed = names.select(file, place.alias("__i"), n.alias("__n"))
    table = placed.select(
        file,
        F.when(F.col("__i") < F.floor(F.col("__n") * F.lit(0.71)), "train")
        .when(F.col("__i") < F.floor(F.col("__n") * F.lit(0.86)), "test").otherwise("live").alias("data_split"),
    )
    return df.join(table, file)


def live_rows(df: DataFrame, split: str = "live") -> DataFrame:
    """The rows of one split in time order, for replay. The spelling of the split is not case-sensitive."""
    return df.filter(F.lower("data_split") == split.lower()).orderBy("base_datetime", "mmsi")


def capped_sample(
    df: DataFrame, max_rows: int, split: str | None = "train", file: str = "source_file", seed: int = 42,
    identity: Sequence[str] = ("mmsi", "base_datetime"),
) -> DataFrame:
    """``max_rows`` rows, the same number of every file, chosen by a seeded hash of their identity.

    What does not divide evenly goes to the first files by name; a file with fewer rows than its part gives all it has.
    The choice is the same on every run and for every partitioning. A file's rows are never ordered as a
    whole, however many it holds: hash buckets are counted, whole buckets are taken up to the cap, and only
    the rows of the bucket at the edge are ranked. The identity must be unique, as it is in Silver.
    """
    from pyspark.sql import Window

    rows = df if split is None else df.filter(F.col("data_split") == split)
    placed = rows.withColumn("__bucket", F.pmod(F.xxhash64(*identity, F.lit(seed)), F.lit(SAMPLE_BUCKETS)))
    counts = placed.groupBy(file, "__bucket").agg(F.count("*").alias("__n"))
    names = counts.select(file).distinct()
    # one row a file
    share = F.expr(f"{int(max_rows)} div __files") + F.when(F.col("__place") <= int(max_rows) % F.col("__files"), 1).otherwise(0)
    caps = names.select(
        file, F.row_number().over(Window.orderBy(file)).alias("__place"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("__files")
    ).select(file, share.alias("__cap"))
    upto = Window.partitionBy(file).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    edges = (
        counts.withColumn("__before", F.sum("__n").over(upto) - F.col("__n"))
        .join(caps, file)
        .filter(F.col("__before") < F.col("__cap"))
        .groupBy(file).agg(F.max("__bucket").alias("__edge"), (F.first("__cap") - F.max("__before")).alias("__room"))
    )
    within = Window.partitionBy(file, "__bucket").orderBy(*identity)
    return (
        placed.join(edges, file)
        .filter(F.col("__bucket") <= F.col("__edge"))
        .withColumn("__rn", F.row_number().over(within))
        .filter((F.col("__bucket") < F.col("__edge")) | (F.col("__rn") <= F.col("__room")))
        .select(*df.columns)
    )


def _mark(control: DataFrame, table: str) -> Column:
    return control.filter(F.col("table_name") == table).agg(F.max("last_loaded")).scalar()


def newer_than(df: DataFrame, column: str, control: DataFrame, table: str) -> DataFrame:
    """Rows with ``column`` above the stored watermark of ``table``; all rows when there is none."""
    mark = _mark(control, table)
    return df.filter(mark.isNull() | (F.col(column).cast("timestamp_ntz") > mark))


def since(df: DataFrame, column: str, control: DataFrame, table: str) -> DataFrame:
    """Like ``newer_than`` with the period of the watermark itself, which may have grown since it was loaded."""
    mark = _mark(control, table)
    return df.filter(mark.isNull() | (F.col(column).cast("timestamp_ntz") >= mark))


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a query on a database connection. Credentials are passed by the caller, never stored."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()
