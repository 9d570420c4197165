"""Packing into training batches with optimal length buckets.

Texts are sequences of tokens; a sequence longer than ``max_length`` is cut into pieces. The lengths of all pieces make
a histogram of at most ``max_length`` rows, and dynamic programming over it finds the ``buckets`` boundaries that pad the
fewest tokens overall. Within a bucket every batch holds as many pieces as fit ``token_budget`` once padded to the
bucket's boundary.

Pieces are numbered within their bucket without sorting a bucket in one task: rows get a cell of at most ``1 << CELL``
input rows when they are read, are numbered within bucket and cell, and cells are stacked by their counts. Batches are
therefore full but for the last one of each bucket.

Defined cases: a null or empty text has no pieces; rows that repeat are packed each; rows without an id are packed too;
without any piece there is no batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import materialise

MAX_LENGTH = 4096
BUCKETS = 16
TOKEN_BUDGET = 65_536
CELL = 16


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The upper bounds of at most ``buckets`` buckets that waste the fewest padding tokens.

    A boundary is always an occurring length, the longest one included. Of equal solutions the one with the shortest
    boundaries is taken.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    rows = np.concatenate(([0], np.cumsum(counts)))
    # sum of lengths is the same for every choice, so the padded size is what to minimise
    best = rows[1:] * lengths
    chosen = [np.zeros(len(lengths), np.int64)]
    for _ in range(1, min(buckets, len(lengths))):
        after, cut = best.copy(), np.zeros(len(lengths), np.int64)
        for j in range(1, len(lengths)):
            cost = best[:j] + (rows[j + 1] - rows[1 : j + 1]) * lengths[j]
            k = int(np.argmin(cost))
            if cost[k] < after[j]:
                after[j], cut[j] = cost[k], k + 1
        best = after
        chosen.append(cut)
    out, j = [], len(lengths)
    for cut in reversed(chosen):
        if j > 0:
            out.append(int(lengths[j - 1]))
            j = int(cut[j - 1])
    return sorted(out)


def pieces(documents: DataFrame, n_tokens: Column, max_length: int) -> DataFrame:
    """``doc_id, piece, first_token, n_tokens, cell``: what there is to pack."""
    sized = documents.select("doc_id", F.coalesce(n_tokens, F.lit(0)).cast("long").alias("total")).withColumn(
        "cell", F.call_function("shiftright", F.monotonically_increasing_id(), F.lit(CELL))
    )
    cut = sized.filter("total > 0").withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {max_length}")))
    )
    first = F.col("piece") * max_length
    return cut.select(
        "doc_id", "piece", first.alias("first_token"),
        F.least(F.lit(max_length).cast("long"), F.col("total") - first).alias("n_tokens"), "cell",
    )


def pack(
    documents: DataFrame, n_tokens: Column | None = None, max_length: int = MAX_LENGTH, buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """Every piece with its bucket, batch and place. ``n_tokens`` defaults to the bytes of ``text`` as byte-level tokens."""
    if token_budget < max_length:
        raise ValueError("token_budget must hold one piece of max_length")
    size = F.octet_length(F.col("text").cast("string")) if n_tokens is None else n_tokens
    # cells depend on how rows were read, so they are fixed by writing them; a row here is a few numbers
    rows = materialise(pieces(documents, size, max_length), "pieces")
    histogram = {r["n_tokens"]: r["count"] for r in rows.groupBy("n_tokens").count().collect()}
    bounds = boundaries(histogram, buckets)
    bucket = F.lit(len(bounds) - 1)
    for k in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[k], k).otherwise(bucket)
    padded = F.element_at(F.array(*(F.lit(b).cast("long") for b in bounds or [1])), F.col("bucket") + 1)
    placed = rows.withColumn("bucket", bucket.cast("int")).withColumn("padded_length", padded)
    here = Window.partitionBy("bucket", "cell").orderBy("doc_id", "piece", "n_tokens")
    counts = placed.groupBy("bucket", "cell").count()
    before = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("row", F.row_number().over(here) - 1).join(offsets, ["bucket", "cell"])
    place = F.col("row") + F.col("offset")
    rows_per_batch = F.expr(f"{token_budget} div padded_length")
    return numbered.select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", "padded_length",
        F.floor(place / rows_per_batch).cast("long").alias("batch"), (place % rows_per_batch).cast("int").alias("place"),
    )
