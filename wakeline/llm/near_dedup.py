"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct ``SHINGLE``-word sequences. Two small collections of hashes are computed: ``ROWS``
bands of two minimum hashes and ``COLUMNS`` single ones. The tables' keys are all pairs (band i, single j): 160 tables
for 42 minimum hashes, where plain banding would compute 480. Two documents with similarity 0.75 share no key at all
with probability 0.4375**16 + 0.25**10, about 3 in a million; with 0.85 it is about 1 in 100 million.

1. Documents with equal sets are one class. The class takes part once, so exact copies cost one row per map task.
2. Classes are routed by band (one row per band, not per key) as packed blobs to buckets of bounded size.
3. In a bucket, classes that share a key and whose 64 further minimum hashes do not rule out the threshold (the bound
   lies 5.7 standard deviations below it) are candidates. A bucket reports a spanning forest of its candidates, not its
   pairs, and from the forests of all buckets follow the candidate components.
4. Sets travel once, to the task of their candidate component. There all pairs that the further hashes do not rule out
   are compared on full sets, but those that are connected already. A component of more than ``TASK_SHINGLES`` is cut
   into blocks, and each pair of blocks is such a task.
5. Components of the confirmed links give each document the smallest document id it reaches.

Classes are named by a 64-bit digest of their set. Sets hold 64-bit shingle hashes.

Defined cases: null or empty texts have an empty set, no links and are kept, as is a row without an id (its
``component_id`` is null). Rows that repeat an id are one node, whatever their texts; each has its own result row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.components import components
from wakeline.llm.rows import free_name, keyed_texts, parts_of, small_batches
from wakeline.llm.text import SPACED, Slice, column, constants, mix, pack, slices, unpack
from wakeline.session import materialise

SHINGLE = 5
ROWS, COLUMNS, CHECKS = 16, 10, 64
#: Of CHECKS agreeing hashes, fewer than this rule a similarity of 0.75 out.
LEAST_AGREE = 28
SMALL = 32
BUCKET_ROWS = 100_000
TASK_SHINGLES = 1_000_000

_FACTORS = constants(51, 2 * ROWS + COLUMNS + CHECKS)
_SKETCH = np.dtype([("bands", "u8", ROWS), ("singles", "u2", COLUMNS), ("checks", "u1", CHECKS)])


def shingle_sets(part: Slice, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, the bounds of each text among them, and the numbers of words."""
    words = part.lowered().words(SPACED)
    at = words.windows(size)
    prints, owner = words.fingerprints(at, size), words.text[at]
    for n in range(1, size):
        few = words.first[:-1][words.counts == n]
        if len(few):
            prints = np.concatenate((prints, words.fingerprints(few, n)))
            owner = np.concatenate((owner, words.text[few]))
    order = np.argsort(owner, kind="stable")
    prints, owner = prints[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(part.n + 1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        prints[lo:hi].sort()
    fresh = np.ones(len(prints), bool)
    fresh[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
    return prints[fresh], np.searchsorted(owner[fresh], np.arange(part.n + 1)), words.counts


def digests(prints: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of each set; 0 for an empty one."""
    full = np.diff(bounds) > 0
    out = np.zeros((2, len(full)), np.uint64)
    if full.any():
        for k, seed in enumerate((np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))):
            out[k, full] = np.add.reduceat(mix(prints ^ seed), bounds[:-1][full])
    return out[0].view(np.int64), out[1].view(np.int64)


def sketches_of(prints: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    full = np.diff(bounds) > 0
    out = np.zeros(len(full), _SKETCH)
    if not full.any():
        return out
    at = bounds[:-1][full]
    low = np.stack([np.minimum.reduceat(prints * f, at) for f in _FACTORS]) >> np.uint64(20)
    for i in range(ROWS):
        out["bands"][full, i] = mix(low[2 * i] * constants(52, 1)[0] + low[2 * i + 1] + np.uint64(i))
    out["singles"][full] = mix(low[2 * ROWS : 2 * ROWS + COLUMNS]).T.astype(np.uint16)
    out["checks"][full] = mix(low[2 * ROWS + COLUMNS :]).T.astype(np.uint8)
    return out


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column(batch, "doc_id")
        for part in slices(column(batch, "text")):
            prints, bounds, _ = shingle_sets(part)
            one, two = digests(prints, bounds)
            rows = sketches_of(prints, bounds)
            flat = pa.Array.from_buffers(pa.binary(rows.itemsize), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(part.first, part.n), pa.array(np.diff(bounds)), pa.array(one), pa.array(two), flat],
                ["doc_id", "n_shingles", "cid", "check", "sketch"],
            )


def flat_sketches(column_of: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column_of.to_pylist()), _SKETCH)


def route(buckets: int):
    """Blobs of (band, class, size, singles, checks) rows, each band's row in the bucket of its value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, sizes = column(batch, "cid").to_numpy(), column(batch, "n_shingles").to_numpy()
            sketches = flat_sketches(column(batch, "sketch"))
            band = sketches["bands"].reshape(-1)
            owner = np.repeat(np.arange(len(cids)), ROWS)
            order = np.argsort(band % np.uint64(buckets), kind="stable")
            cut = np.searchsorted((band % np.uint64(buckets))[order], np.arange(buckets + 1, dtype=np.uint64))
            names, blobs = [], []
            for k in range(buckets):
                mine = order[cut[k] : cut[k + 1]]
                if len(mine):
                    who = owner[mine]
                    names.append(k)
                    blobs.append(pack(
                        band[mine], cids[who], sizes[who], sketches["singles"][who].reshape(-1), sketches["checks"][who].reshape(-1)
                    ))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return run


class Bucket:
    """All rows of a bucket in the order of their bands."""

    def __init__(self, blobs: list[bytes]) -> None:
        parts = [unpack(b) for b in blobs]
        band, cid, size, singles, checks = (np.concatenate([p[k] for p in parts]) for k in range(5))
        order = np.lexsort((cid, band))
        self.band, self.cid, self.size = band[order], cid[order], size[order]
        self.singles = singles.reshape(-1, COLUMNS)[order]
        self.checks = checks.reshape(-1, CHECKS)[order]

    def plausible(self, x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
        """Whether sizes and further hashes allow a similarity of 0.75."""
        small, large = np.minimum(self.size[x], self.size[y]), np.maximum(self.size[x], self.size[y])
        return (4 * small >= 3 * large) & ((self.checks[x] == self.checks[y]).sum(axis=1) >= LEAST_AGREE)

    def small_runs(self, starts: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidates among up to ``SMALL`` classes of a band, by their distance in the run."""
        run, last = np.repeat(length, length), np.repeat(starts + length, length)
        small = np.flatnonzero((run > 1) & (run <= SMALL))
        for step in range(1, int(run[small].max()) if len(small) else 0):
            x = small[small + step < last[small]]
            x = x[(self.singles[x] == self.singles[x + step]).any(axis=1)]
            x = x[self.plausible(x, x + step)]
            yield x, x + step

    def large_run(self, members: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A spanning forest of the candidates of one key: each class looks once at those not reached so far."""
        left, reached = members, []
        while len(left):
            if not reached:
                reached, left = [left[0]], left[1:]
            at = reached.pop()
            fit = self.plausible(left, at)
            if fit.any():
                yield np.full(int(fit.sum()), at), left[fit]
                reached += left[fit].tolist()
                left = left[~fit]

    def forest(self) -> list[tuple[int, int]]:
        """Candidate pairs of classes that connect what the candidates of this bucket connect, and close no circle."""
        n = len(self.band)
        starts = np.flatnonzero(np.concatenate(([True], self.band[1:] != self.band[:-1]))) if n else np.zeros(0, np.int64)
        length = np.diff(np.append(starts, n))
        top: dict[int, int] = {}
        out: list[tuple[int, int]] = []

        def join(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> None:
            for x, y in found:
                for a, b in zip(self.cid[x].tolist(), self.cid[y].tolist(), strict=True):
                    ra, rb = root(top, a), root(top, b)
                    if ra != rb:
                        top[max(ra, rb)] = min(ra, rb)
                        out.append((a, b))

        join(self.small_runs(starts, length))
        for lo, hi in zip(starts[length > SMALL].tolist(), (starts + length)[length > SMALL].tolist(), strict=True):
            for j in range(COLUMNS):
                order = lo + np.argsort(self.singles[lo:hi, j], kind="stable")
                edge = np.flatnonzero(np.concatenate(([True], np.diff(self.singles[order, j]) != 0, [True])))
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    if b - a > 1:
                        join(self.large_run(order[a:b]))
        return out


def root(top: dict[int, int], x: int) -> int:
    while (up := top.get(x, x)) != x:
        top[x] = x = top.get(up, up)
    return x


def links_table(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def bucket_forest(table: pa.Table) -> pa.Table:
    return links_table(Bucket(table.column("blob").to_pylist()).forest())


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each text of ``cid, text`` rows whose digest is that ``cid``."""
    for batch in batches:
        cids = column(batch, "cid").to_numpy()
        for part in slices(column(batch, "text")):
            prints, bounds, _ = shingle_sets(part)
            one, _ = digests(prints, bounds)
            mine = np.flatnonzero(one == cids[part.first : part.first + part.n])
            values = pa.array(prints.view(np.int64))
            sets = [values.slice(bounds[k], bounds[k + 1] - bounds[k]) for k in mine]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64))).astype(np.int32)
            flat = pa.concat_arrays(sets) if sets else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(one[mine]), pa.ListArray.from_arrays(offsets, flat)], ["cid", "shingles"])


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= 75 * union on sorted sets."""
    if 4 * min(len(x), len(y)) < 3 * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= 75 * (len(x) + len(y) - common)


def settle(group: pa.Table) -> pa.Table:
    """The links that connect the classes of each candidate component in this task, found over all its pairs."""
    flat = column(group, "shingles")
    offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy().view(np.uint64)
    cids, comps = column(group, "cid").to_numpy(), column(group, "comp").to_numpy()
    checks = np.frombuffer(b"".join(column(group, "checks").to_pylist()), np.uint8).reshape(-1, CHECKS)
    _, first = np.unique(cids, return_index=True)
    order = first[np.lexsort((first, comps[first]))]
    edge = np.flatnonzero(np.concatenate(([True], np.diff(comps[order]) != 0, [True]))) if len(order) else np.zeros(1, np.int64)
    sets = [values[offsets[k] : offsets[k + 1]] for k in range(len(cids))]
    out: list[tuple[int, int]] = []
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        mine = order[lo:hi]
        size = np.array([len(sets[k]) for k in mine])
        label = np.arange(len(mine))
        for i in range(len(mine) - 1):
            rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
            rest = rest[4 * np.minimum(size[rest], size[i]) >= 3 * np.maximum(size[rest], size[i])]
            agree = (checks[mine[rest]] == checks[mine[i]]).sum(axis=1)
            rest = rest[agree >= LEAST_AGREE][np.argsort(-agree[agree >= LEAST_AGREE], kind="stable")]
            for j in rest.tolist():
                if label[j] != label[i] and linked(sets[mine[i]], sets[mine[j]]):
                    label[label == label[j]] = label[i]
                    out.append((int(cids[mine[i]]), int(cids[mine[j]])))
    return links_table(out)


def confirmed(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links that connect all classes that links connect, within the components of the candidate ``pairs``."""
    groups = components(pairs).select(F.col("node").alias("cid"), F.col("label").alias("comp"))
    member = classes.select("cid", "class_id", "n_shingles", F.expr(f"substring(sketch, {1 + _SKETCH.itemsize - CHECKS}, {CHECKS})").alias("checks"))
    wanted = groups.join(member, "cid")
    sizes = wanted.groupBy("comp").agg(F.sum("n_shingles").alias("weight"))
    wanted = materialise(wanted.join(sizes, "comp"), "wanted")
    tasks = parts_of(wanted.agg(F.sum("n_shingles")).first()[0] or 0, TASK_SHINGLES)
    # both sides by their keys whatever their sizes here, so that the plan of a small corpus is that of a large one
    sets = (
        texts.join(wanted.select("cid", F.col("class_id").alias("doc_id")).hint("merge"), "doc_id").select("cid", "text")
        .mapInArrow(set_batches, "cid long, shingles array<long>")
    )
    found = sets.join(wanted.select("cid", "comp", "checks", "weight"), "cid")
    # a block is half a task: two of them meet in one
    blocks = F.ceil(2 * F.col("weight") / TASK_SHINGLES)
    mine = F.pmod(F.xxhash64("cid"), blocks)
    pair = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j")))
    whole = F.array(F.struct(F.pmod(F.xxhash64("comp"), F.lit(tasks)).alias("i"), F.lit(-1).cast("long").alias("j")))
    dealt = found.withColumn("block", F.explode(F.when(F.col("weight") <= TASK_SHINGLES, whole).otherwise(pair)))
    dealt = dealt.withColumn("owner", F.when(F.col("weight") <= TASK_SHINGLES, F.lit(0).cast("long")).otherwise(F.col("comp")))
    return dealt.select("owner", "block", "cid", "comp", "checks", "shingles").groupBy("owner", "block").applyInArrow(settle, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row for each document row."""
    texts = small_batches(keyed_texts(documents))
    sketches = materialise(
        texts.mapInArrow(sketch_batches, "doc_id long, n_shingles long, cid long, check long, sketch binary"), "sketches"
    )
    full = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = materialise(
        full.groupBy("cid", "check", "n_shingles").agg(F.min("doc_id").alias("class_id"), F.first("sketch").alias("sketch")), "classes"
    )
    buckets = parts_of(classes.count() * ROWS, BUCKET_ROWS)
    blobs = classes.mapInArrow(route(buckets), "bucket int, blob binary")
    pairs = materialise(blobs.groupBy("bucket").applyInArrow(bucket_forest, "a long, b long"), "pairs")
    # rows that repeat an id with another text are one node: tie their classes to the class of the smallest digest
    ties = (
        full.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("most")).filter("a <> most")
        .join(full.select("doc_id", F.col("cid").alias("b")), "doc_id").filter("a <> b").select("a", "b")
    )
    labels = components(confirmed(texts, classes, pairs).unionByName(ties))
    labels = labels.select(F.col("node").alias("cid"), "label")
    named = classes.select("cid", "class_id").join(labels, "cid", "left")
    named = named.withColumn("label", F.coalesce("label", "cid"))
    lowest = named.groupBy("label").agg(F.min("class_id").alias("component_id"))
    known = named.join(lowest, "label").select("cid", "component_id")
    out = sketches.select("doc_id", "n_shingles", F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("cid")).alias("cid"))
    component = F.coalesce("component_id", "doc_id")
    return out.join(known, "cid", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they are; of rows that repeat an id, the first by text."""
    kept = near_duplicates(documents).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    place = free_name("place", *documents.columns)
    named = documents.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    first = named.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).filter(F.col(place) == 1)
    return first.drop(place).unionByName(documents.filter("doc_id is null"))
