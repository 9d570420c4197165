"""Near-duplicate vectors by spherical-cap filters.

Vectors of one label are linked if their cosine is at least ``THRESHOLD``. A filter is a direction, and a vector passes
it if it lies within a cap around it. The directions are a product code: the space is turned at random and cut into two
halves, each half has a random code of ``size`` unit vectors, and every pair of them is a direction. So the
``size ** 2`` directions cost ``2 * size`` products a vector, and the list of all filters that a vector passes is decoded
from the two lists of products. Several codes, turned differently, make up for the luck of a single one.

1. Equal vectors of a label are one class, which takes part once.
2. Each class is decoded to its filters. Filters with the same first direction, and second directions out of one range,
   are one *place*: a class travels once to each of its places, with its vector.
3. Classes that meet in a place are compared: products of matrices, in double precision on the vectors themselves.
   A pair is counted in the lowest place that both have, which is found by decoding the linked vectors again, so no
   pair is counted twice and none is written out: a place returns a number a class, and a spanning forest of its links.
4. A place with more than ``PLACE_ROWS`` classes is cut into parts, and every two parts meet in a task of their own.
5. Components of the forests give each vector the smallest id it reaches.

The code's size follows the number of classes (its square root), so that the classes of a place stay few. The cap is
set so that a random vector passes ``LISTED`` filters of a code. How often one code loses a pair at exactly the threshold
is found on random pairs, and so many codes are used that all together lose it with probability ``LOSS``;
more similar pairs are lost far less often (README has measured figures). What is linked is certain in any case.

Products that decide about filters are those of whole numbers (vectors and codes are rounded to them), so every
task decodes a vector to the same filters, however it groups its work.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows without a label,
have no links; their component is their own id, and they are kept. Vectors of different lengths are not linked. Rows
that repeat an id are one node for components, and each has its own row and its own links. A row without an id counts as
a vector; its component is the smallest id it reaches, null if there is none, and it is kept. An empty table has no
rows. Only the three columns are read, whatever else the table has.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.components import components
from wakeline.llm.rows import parts_of, small_batches
from wakeline.llm.text import column
from wakeline.session import materialise

THRESHOLD = 0.93
#: Filters of one code that a random vector passes.
LISTED = 8
#: Probability that a pair at exactly the threshold has no place in common.
LOSS = 1e-5
LEAST_CODE = 64
PLACE_ROWS = 2048
BUCKET_ROWS = 50_000
CHUNK = 1024
#: Random vectors on which a code is measured.
TRIALS = 512

_SCALE = 1 << 14


@dataclass(frozen=True)
class Code:
    """What all tasks must agree on to decode vectors of ``dims`` components."""

    dims: int
    size: int
    ranges: int
    cap: float
    codes: int
    threshold: float


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(maxsize=64)
def halves(dims: int, size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The two half codes of code ``k`` as whole numbers; a direction is a row of the one plus a row of the other."""
    rng = np.random.Generator(np.random.PCG64([13, dims, size, k]))
    wide = max(dims, 4)
    turn = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:, :dims]
    cut = wide // 2
    pair = (unit(rng.standard_normal((size, n))) @ turn[part] for n, part in ((cut, slice(0, cut)), (wide - cut, slice(cut, wide))))
    one, two = (np.ascontiguousarray(np.rint(x * _SCALE).T) for x in pair)
    return one, two


def rounded(x: np.ndarray) -> np.ndarray:
    """Vectors as whole numbers of a fixed length; sums of their products with a code are exact."""
    return np.rint(unit(x) * _SCALE)


def decoded(q: np.ndarray, code: Code, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places, in their order, of the filters of code ``k`` that the rounded vectors ``q`` pass."""
    one, two = halves(code.dims, code.size, k)
    first, second = q @ one, q @ two
    width = math.ceil(code.size / code.ranges)
    best = np.maximum.reduceat(second, np.arange(0, code.size, width), axis=1)
    row, i = np.nonzero(first >= code.cap - best.max(axis=1, keepdims=True))
    at, part = np.nonzero(first[row, i][:, None] + best[row] >= code.cap)
    return row[at], (k * code.size + i[at]) * code.ranges + part


def random_pairs(dims: int, cosine: float, n: int = TRIALS) -> tuple[np.ndarray, np.ndarray]:
    """Random directions, and others at that cosine to them."""
    rng = np.random.Generator(np.random.PCG64([17, dims]))
    x, y = unit(rng.standard_normal((n, dims))), rng.standard_normal((n, dims))
    if dims == 1:
        return x, x
    y = unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * y


def cap_of(dims: int, size: int) -> float:
    """The least product at which random vectors pass ``LISTED`` filters on average."""
    q = rounded(random_pairs(dims, 0)[0])
    one, two = halves(dims, size, 0)
    first, second = q @ one, np.sort(q @ two, axis=1)
    low, high = -2.0 * _SCALE**2, 2.0 * _SCALE**2
    while high - low > 1:
        cap = np.floor((low + high) / 2)
        n = sum(size * size - int(np.searchsorted(s, cap - f).sum()) for f, s in zip(first, second, strict=True))
        low, high = (cap, high) if n > LISTED * len(q) else (low, cap)
    return high


def code_for(dims: int, classes: int, threshold: float = THRESHOLD) -> Code:
    """The code for that many classes, measured on random pairs on the driver."""
    size = max(LEAST_CODE, math.isqrt(classes))
    cap = cap_of(dims, size)
    left, right = map(rounded, random_pairs(dims, threshold))
    trial = Code(dims, size, 1, cap, 4, threshold)
    # so many ranges that a place of one label with all rows has at most PLACE_ROWS in expectation
    places = len(decoded(left, trial, 0)[0]) / len(left)
    ranges = min(size, parts_of(math.ceil(classes * places / size), PLACE_ROWS))
    trial = Code(dims, size, ranges, cap, 4, threshold)
    lost = 1.0
    for k in range(trial.codes):
        a, b = (set(zip(*(x.tolist() for x in decoded(q, trial, k)), strict=True)) for q in (left, right))
        lost -= len({row for row, _ in a & b}) / len(left) / trial.codes
    lost = min(max(lost, 1 / len(left)), 0.9)
    return Code(dims, size, ranges, cap, math.ceil(math.log(LOSS) / math.log(lost)), threshold)


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, cid, label, dims, vec``; ``cid`` names label and vector, and is null where the row takes no part."""
    for batch in batches:
        lists, labels = column(batch, "vec"), column(batch, "label").to_pylist()
        kind = np.float32 if lists.type.value_type == pa.float32() else np.float64
        cids, dims, vectors = [], [], []
        for label, value in zip(labels, lists, strict=True):
            x = None
            if label is not None and value.is_valid and not value.values.null_count:
                x = value.values.to_numpy(zero_copy_only=False).astype(kind) + kind(0)
                x = x if len(x) and np.isfinite(x).all() and x.any() else None
            blob = None if x is None else x.tobytes()
            cids.append(None if x is None else hashlib.blake2b(f"{len(label)}:{label}{len(x)}:".encode() + blob, digest_size=16).hexdigest())
            dims.append(None if x is None else len(x))
            vectors.append(blob)
        yield pa.RecordBatch.from_arrays(
            [column(batch, "vec_id"), pa.array(cids, pa.string()), column(batch, "label"), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
            ["vec_id", "cid", "label", "dims", "vec"],
        )


def matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    """Vectors in double precision; each is divided by a power of two so that squares neither overflow nor vanish."""
    kind = np.float32 if len(vectors[0]) == 4 * dims else np.float64
    x = np.frombuffer(b"".join(vectors), kind).reshape(-1, dims).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def routed(codes: dict[int, Code], with_vectors: bool):
    """A row for each class and place, with the vector or, to count them, without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors = column(batch, "dims").to_numpy(), column(batch, "vec").to_pylist()
            for d in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == d)
                for lo in range(0, len(mine), CHUNK):
                    some = mine[lo : lo + CHUNK]
                    q = rounded(matrix([vectors[k] for k in some], d))
                    for k in range(codes[d].codes):
                        row, place = decoded(q, codes[d], k)
                        rows = batch.take(pa.array(some[row])).select(["cid", "label", "dims", "n", "vec"] if with_vectors else ["label", "dims"])
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(place, pa.int64())], [*rows.schema.names, "place"])

    return run


class Met:
    """The classes that meet in one place, or in two parts of it."""

    def __init__(self, code: Code, place: int, x: np.ndarray, n: np.ndarray, part: np.ndarray) -> None:
        self.code, self.place, self.x, self.n, self.part = code, place, x, n, part
        self.apart = len(np.unique(part)) > 1

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """All linked pairs, each once; parts that meet only to be compared have no pairs of their own here."""
        length = np.sqrt((self.x * self.x).sum(axis=1))
        left, right = [], []
        for lo in range(0, len(self.x), CHUNK):
            cosine = (self.x[lo : lo + CHUNK] @ self.x[lo:].T) / (length[lo : lo + CHUNK, None] * length[lo:])
            a, b = np.nonzero(np.triu(cosine >= self.code.threshold, 1))
            left.append(a + lo)
            right.append(b + lo)
        a, b = np.concatenate(left), np.concatenate(right)
        if self.apart:
            across = self.part[a] != self.part[b]
            a, b = a[across], b[across]
        return a, b

    def lower(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and places below this one that they have."""
        q = rounded(self.x[rows])
        found = [decoded(q, self.code, k) for k in range(self.place // (self.code.size * self.code.ranges) + 1)]
        row, place = (np.concatenate(x) for x in zip(*found, strict=True))
        return row[place < self.place], place[place < self.place]

    def first_met(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have no lower place in common."""
        rows, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        a, b = at[: len(a)], at[len(a) :]
        row, place = self.lower(rows)
        known, place, times = np.unique(place, return_inverse=True, return_counts=True)
        twice = times[place] > 1
        row, place = row[twice], place[twice]
        new = np.ones(len(a), bool)
        for lo in range(0, len(known), CHUNK):  # so many lower places at once as one matrix
            here = (place >= lo) & (place < lo + CHUNK)
            if not here.any():
                continue
            some, short = np.unique(row[here], return_inverse=True)
            has = np.zeros((len(some), CHUNK), np.float32)
            has[short, place[here] - lo] = 1
            spot = np.full(len(rows), -1)
            spot[some] = np.arange(len(some))
            both = np.flatnonzero(new & (spot[a] >= 0) & (spot[b] >= 0))
            if len(both) * 16 < len(some) ** 2:  # few of all pairs: look at those
                for k in range(0, len(both), 1 << 16):
                    pair = both[k : k + (1 << 16)]
                    new[pair] = ~np.einsum("ij,ij->i", has[spot[a[pair]]], has[spot[b[pair]]]).astype(bool)
            else:
                new[both] = (has @ has.T)[spot[a[both]], spot[b[both]]] == 0
        return new


def forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """The places of pairs that connect what all pairs connect, and close no circle."""
    top: dict[int, int] = {}
    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        while (up := top.get(y, y)) != y:
            top[y] = y = top.get(up, up)
        if x != y:
            top[y] = x
            out.append(k)
    return out


def compared(codes: dict[int, Code]):
    """For the places of a bucket: ``a, n`` numbers of links by class, and ``a, b`` links of a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        meeting = np.stack([column(table, c).to_numpy() for c in ("dims", "place", "cell")])
        labels = column(table, "label").dictionary_encode()
        key = np.vstack((labels.indices.to_numpy(), meeting))
        order = np.lexsort(key)
        edge = np.flatnonzero(np.concatenate(([True], (np.diff(key[:, order]) != 0).any(axis=0), [True]))) if len(order) else np.zeros(1, int)
        cids, vectors = column(table, "cid"), column(table, "vec").to_pylist()
        weight, part = column(table, "n").to_numpy(), column(table, "part").to_numpy()
        one, two, number = [], [], []
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            mine = order[lo:hi]
            if len(mine) < 2:
                continue
            d, place = int(meeting[0, mine[0]]), int(meeting[1, mine[0]])
            met = Met(codes[d], place, matrix([vectors[k] for k in mine], d), weight[mine], part[mine])
            a, b = met.links()
            if not len(a):
                continue
            new = met.first_met(a, b)
            a, b = a[new], b[new]
            links = np.bincount(a, met.n[b], len(mine)) + np.bincount(b, met.n[a], len(mine))
            have, tree = np.flatnonzero(links), forest(a, b)
            one += [cids.take(pa.array(mine[have])), cids.take(pa.array(mine[a[tree]]))]
            two += [pa.nulls(len(have), pa.string()), cids.take(pa.array(mine[b[tree]]))]
            number += [pa.array(np.rint(links[have]).astype(np.int64)), pa.array(np.zeros(len(tree), np.int64))]
        if not one:
            return pa.table({"a": pa.array([], pa.string()), "b": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        return pa.table({"a": pa.concat_arrays(one), "b": pa.concat_arrays(two), "n": pa.concat_arrays(number)})

    return run


def meetings(classes: DataFrame, codes: dict[int, Code]) -> DataFrame:
    """Links counted by class and a forest of them, from all places."""
    place = ["label", "dims", "place"]
    counts = classes.mapInArrow(routed(codes, False), "label string, dims int, place long").groupBy(*place).agg(F.count("*").alias("rows"))
    counts = materialise(counts, "cap-counts")
    # parts are half a task: two of them meet in one
    hot = counts.filter(F.col("rows") > PLACE_ROWS).select(*place, F.ceil(2 * F.col("rows") / PLACE_ROWS).alias("parts"))
    rows = classes.mapInArrow(routed(codes, True), "cid string, label string, dims int, n long, vec binary, place long")
    rows = rows.join(materialise(hot, "cap-hot"), place, "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    part = F.pmod(F.xxhash64("cid"), F.col("parts"))
    rows = rows.withColumn("part", part)
    # the cell of parts i <= j; a part that meets itself has a cell alone
    cell = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda x: F.least(x, F.col("part")) * F.col("parts") + F.greatest(x, F.col("part")),
    )
    rows = rows.withColumn("cell", F.explode(cell))
    total = counts.agg(F.sum(F.col("rows") * F.ceil(2 * F.col("rows") / PLACE_ROWS))).first()[0] or 0
    bucket = F.pmod(F.xxhash64(*place, "cell"), F.lit(parts_of(total, BUCKET_ROWS)))
    return rows.select(bucket.alias("bucket"), *place, "cell", "part", "cid", "n", "vec").groupBy("bucket").applyInArrow(
        compared(codes), "a string, b string, n long"
    )


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row for each row of ``table``."""
    vec = F.col(vector_col)
    if table.schema[vector_col].dataType != T.ArrayType(T.FloatType()):
        vec = vec.cast("array<double>")
    rows = small_batches(table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec")))
    rows = materialise(rows.mapInArrow(read, "vec_id long, cid string, label string, dims int, vec binary"), "vectors")
    full = rows.filter("cid is not null")
    classes = materialise(
        full.groupBy("cid", "label", "dims").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("n"), F.first("vec").alias("vec")),
        "vector-classes",
    )
    lengths = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    codes = {d: code_for(d, n, threshold) for d, n in lengths.items()}
    found = materialise(meetings(classes, codes), "vector-links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    # rows that repeat an id with another vector are one node: tie their classes to the first of them
    ties = (
        full.groupBy("vec_id").agg(F.min("cid").alias("a"), F.max("cid").alias("most")).filter("a <> most and vec_id is not null")
        .join(full.select("vec_id", F.col("cid").alias("b")), "vec_id").filter("a <> b").select("a", "b")
    )
    labels = components(found.filter("b is not null").select("a", "b").unionByName(ties))
    named = classes.select("cid", "class_id", "n").join(labels.select(F.col("node").alias("cid"), F.col("label").alias("comp")), "cid", "left")
    named = named.withColumn("comp", F.coalesce("comp", "cid"))
    lowest = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    known = named.join(lowest, "comp").join(counts, "cid", "left").select(
        "cid", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "cid").join(known, "cid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
