"""Merkle manifest of a table: a root over all rows, and for each row the proof that it belongs there.

``H`` is the lower-case hex SHA-256 of its inputs, one after the other, digests as hex text. A row's leaf is the ``H``
of its fields, each ``-`` if null and else byte count, ``:`` and value. Per group the leaves ascend by id; while
several nodes remain, every ``FAN`` consecutive ones (the last run may have fewer, even one) become their ``H``. What
remains is the group's subroot, and the subroots, ordered by group, make the root by the same rule.

1. A row's rank in its group comes from one exchange by range: the place within a partition plus the rows of the
   group in the partitions before. No window holds a group.
2. The rank is written as digits to the base ``FAN``. Rows of a *block* (``FAN**DIGITS`` ranks) meet in one task, and
   the digits are grouped away one after the other there, the lowest first: each node becomes a struct that holds its
   digest and the structs of its children. One exchange serves all digits, and a block is one row of bounded size.
3. The digests of the blocks are the rows of the next round, until each group has one node; so the number of rounds
   is the logarithm of the largest group to the base ``FAN**DIGITS``. Subroots go the same way.
4. The path above a block is joined to the block, one row for up to ``FAN**DIGITS`` leaves. Below it, nested
   transforms and one explode emit the proofs of all leaves: rows themselves are never joined.

Only ids and digests travel; texts are read once and hashed where they are read.

Defined cases: an empty table has no rows and no root. A null group comes first, as one of its own, apart from the
empty text. Rows without an id come first in their group. Rows that repeat an id are leaves of their own, ordered by
leaf; wholly equal rows are interchangeable, and their proofs differ by their places. A group of one row has its leaf as
subroot and no siblings there. Other columns of the table are left alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wakeline.llm.rows import parts_of
from wakeline.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Digits grouped away in one block: 4096 leaves, some hundred bytes each.
DIGITS = 4
BLOCK = FAN**DIGITS
PART_ROWS = 200_000

_UPPER = "".join(map(chr, range(65, 91)))
_STEP = T.ArrayType(T.StructType([
    T.StructField("left", T.StringType()), T.StructField("right", T.StringType()), T.StructField("folds", T.BooleanType()),
]))


def leaf(values: list[Column]) -> Column:
    """``H`` of the framed values."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def leaves(table: DataFrame, fields: tuple[str, ...], id_col: str, group_col: str, other: Column | None = None) -> DataFrame:
    """``grouped, grp, id, leaf, other``: one row for each row; ``grouped`` is false where there is no group."""
    return table.select(
        F.col(group_col).isNotNull().alias("grouped"), F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("grp"),
        F.col(id_col).alias("id"), leaf([F.col(f) for f in fields]).alias("leaf"),
        (F.lit(None).cast("string") if other is None else other).alias("other"),
    )


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Stored ``rows`` with ``place``, the rank from 0 within their group, and ``total``, the size of the group."""
    # equal rows are dealt by their place in the input, so that a flood of them does not end in one partition
    dealt = rows.withColumn("spot", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts_of(rows.count(), PART_ROWS), *group, *order, "spot").sortWithinPartitions(*group, *order)
    dealt = materialise(dealt.withColumn("spot", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("spot", 33).alias("part")
    spans = dealt.groupBy(*group, part).agg(F.min("spot").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    spans = spans.select(
        *group, "part", "first", F.sum("n").over(whole).alias("total"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before"),
    )
    placed = dealt.withColumn("part", part).join(spans, [*group, "part"])
    return placed.withColumn("place", F.expr("spot - first + before")).drop("spot", "part", "first", "before")


def digit(k: int) -> Column:
    return F.expr(f"pmod(place div {FAN**k}, {FAN})")


def several(level: int) -> Column:
    """Whether several nodes remain below ``level``, so that they become a digest once more."""
    return F.ceil(F.col("total") / FAN ** (level - 1)) > 1


def nested(rows: DataFrame, group: list[str]) -> DataFrame:
    """``group, block, total, digest, kids``: blocks of ``rows(group, place, total, digest, item)`` as nested structs."""
    digits = [f"d{k}" for k in range(DIGITS)]
    nodes = rows.select(
        *group, "total", F.expr(f"place div {BLOCK}").alias("block"), *(digit(k).alias(name) for k, name in enumerate(digits)),
        "digest", F.col("item").alias("below"),
    ).repartition(*group, "block")
    for level in range(1, DIGITS + 1):
        kid = F.struct(F.col(digits[level - 1]).alias("digit"), "digest", "below")
        kids = F.array_sort(F.collect_list(kid), lambda a, b: (a["digit"] - b["digit"]).cast("int"))
        nodes = nodes.groupBy(*group, "block", "total", *digits[level:]).agg(kids.alias("below"))
        joined = F.sha2(F.array_join(F.col("below.digest"), ""), 256)
        nodes = nodes.withColumn("digest", F.when(several(level), joined).otherwise(F.col("below")[0]["digest"]))
    return nodes.withColumnRenamed("below", "kids")


def paths(kids: Column, above: Column, level: int) -> Column:
    """All items below ``kids``, which stand at ``level``, as an array of ``item, path``; a path leads from the item up."""
    digests = kids["digest"]

    def one(kid: Column, at: Column) -> Column:
        step = F.struct(
            F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"),
            F.array_join(F.slice(digests, at + 2, F.lit(FAN)), "").alias("right"), several(level).alias("folds"),
        )
        path = F.concat(F.array(step), above)
        if level == 1:
            return F.struct(kid["below"].alias("item"), path.alias("path"))
        return paths(kid["below"], path, level - 1)

    found = F.transform(kids, one)
    return found if level == 1 else F.flatten(found)


def blocks_below(rows: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """The stored blocks of ``rows`` with ``above``, the path from each block up, and the ``top`` of its group; all tops."""
    blocks = materialise(nested(rows, group), "merkle-blocks")
    most = blocks.agg(F.max("total")).first()[0] or 0
    if most <= BLOCK:
        top = F.col("digest").alias("top")
        return blocks.select("*", F.array().cast(_STEP).alias("above"), top), blocks.select(*group, top)
    upper = blocks.select(
        *group, F.ceil(F.col("total") / BLOCK).alias("total"), F.col("block").alias("place"), "digest", F.col("block").alias("item")
    )
    higher, tops = blocks_below(upper, group)
    known = emitted(higher, group, "top").select(*group, F.col("item").alias("block"), F.col("path").alias("above"), "top")
    return blocks.join(known, [*group, "block"]), tops


def emitted(blocks: DataFrame, group: list[str], *more: str) -> DataFrame:
    """``group, item, path`` and columns ``more`` of the block, a row for each item."""
    return blocks.select(*group, *more, F.explode(paths(F.col("kids"), F.col("above"), DIGITS)).alias("x")).select(
        *group, *more, F.col("x.item").alias("item"), F.col("x.path").alias("path")
    )


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings of ``path`` make."""
    return F.aggregate(path, start, lambda acc, s: F.when(s["folds"], F.sha2(F.concat(s["left"], acc, s["right"]), 256)).otherwise(acc))


def proof_digest(path: Column) -> Column:
    """``H`` of the siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    table: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", other: Column | None = None
) -> DataFrame:
    """``id, grp, leaf, subroot, root, path, other``, one row for each row of ``table``; ``grp`` is null without a group.

    ``path`` is the proof: per level the digests ``left`` and ``right`` of the node, and whether the level ``folds``.
    ``other`` is an expression of ``table`` that is carried along, such as the leaf of another version of the row.
    """
    group = ["grouped", "grp"]
    placed = ranked(materialise(leaves(table, fields, id_col, group_col, other), "merkle-leaves"), group, ["id", "leaf"])
    blocks, tops = blocks_below(
        placed.select(*group, "place", "total", F.col("leaf").alias("digest"), F.struct("id", "leaf", "other").alias("item")), group
    )
    # the subroots are the leaves of one more tree, whose only group is the whole table
    subroots = ranked(tops.withColumn("all", F.lit(0)), ["all"], group).select(
        "all", "place", "total", F.col("top").alias("digest"), F.struct(*group).alias("item")
    )
    crown, _ = blocks_below(subroots, ["all"])
    roots = emitted(crown, ["all"], "top").select("item.*", F.col("top").alias("root"), F.col("path").alias("beyond"))
    whole = blocks.join(materialise(roots, "merkle-roots"), group).withColumn("above", F.concat("above", "beyond"))
    return emitted(whole, group, "top", "root").select(
        "item.id", F.when(F.col("grouped"), F.col("grp")).alias("grp"), "item.leaf", F.col("top").alias("subroot"), "root", "path",
        "item.other",
    )


def verified(proofs: DataFrame, table: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """``id, verified`` for each row of ``table``: whether some proof of its id leads from its present leaf to the root."""
    now = leaves(table, fields, id_col, group_col).select("id", F.col("leaf").alias("present"))
    known = proofs.select(F.col("id").alias("known"), "path", "root")
    fits = F.coalesce(folded(F.col("present"), F.col("path")) == F.col("root"), F.lit(False))
    return now.join(known, F.col("id").eqNullSafe(F.col("known")), "left").groupBy("id", "present").agg(
        F.max(fits).alias("verified")
    ).select("id", "verified")


def report(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, where each row whose id's CRC-32 is a multiple
    of 3 is checked with its text in lower case."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    tampered = leaf([lowered if f == "text" else F.col(f) for f in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    proofs = manifest(documents, other=F.when(hit, tampered))
    root = folded(F.coalesce("other", "leaf"), F.col("path"))
    # the fold is an own column before it is compared, so that it is computed once
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
