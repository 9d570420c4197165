"""Repeated passages of bytes, by the common-prefix interval tree of an enhanced suffix array.

A suffix array of all bytes of a large corpus does not fit the cluster it describes, and nearly all suffixes share no
long prefix with any other. So suffixes are first sent where their relatives are:

1. In every string of ``size`` bytes one ``GRAM``-byte sequence is chosen by its hash, its anchor. Equal strings choose
   equal anchors, so strings whose anchor occurs in one document only are unique. Batches of documents ask buckets of
   anchor hashes which of theirs occur elsewhere; the answer is one bit each.
2. Consecutive strings with the same anchor overlap and travel as one segment of at most ``2 * size`` bytes, the distinct
   segments of a batch once, to the bucket of their anchor. Whatever the text, equal strings meet in one bucket.
3. A bucket sorts the suffixes of its segments, takes the common-prefix lengths of neighbours, and cuts the interval tree
   at depth ``size``: an interval there holds all occurrences of one string. An occurrence in a document with a larger
   id than the smallest in its interval is a repeat. Texts are compared as bytes; hashes only send them.
4. The batch marks the bytes its repeats cover.

:func:`maximal_repeats` looks at the tree below that cut: it scans the array with a stack, and reports the intervals whose
occurrences differ in the byte to the left as well, each with all its occurrences. A bucket then holds every occurrence
of its strings, which the removal does not need.

Defined cases: a null text is empty; texts shorter than ``size`` lose nothing; rows without an id neither lose bytes nor
count as an earlier document; rows that repeat an id do not remove one another's bytes, and each has its result row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.exchange import BATCH_BYTES, bits, blob_rows, by_bucket, dealt, flags_of, heads, ranked, table, table_of
from wakeline.llm.rows import parts_of
from wakeline.llm.text import Slice, column, covered, gaps, pack, runs, slices, unpack
from wakeline.llm.winnowing import smallest

SIZE, GRAM = 50, 24
ANCHOR_BYTES = 16 << 20
SEGMENT_BYTES = 6 << 20

_ASKED = {"batch": pa.int32(), "step": pa.int32(), "bucket": pa.int32(), "blob": pa.binary()}
_SPARK_ASKED = "batch int, step int, bucket int, blob binary"
_RESULT = {
    "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "starts": pa.list_(pa.int32()),
    "ends": pa.list_(pa.int32()), "kept_sha256": pa.string(), "kept": pa.binary(),
}
_SPARK_RESULT = "doc_id long, n_bytes long, n_removed long, starts array<int>, ends array<int>, kept_sha256 string, kept binary"


def segments(part: Slice, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor: first string, number of strings, hash of the anchor, text."""
    n = len(part.data) - size + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64), none
    grams = part.grams(gram)
    place = np.uint64(max(1, int(len(grams) - 1).bit_length()))
    mask = np.uint64((1 << int(place)) - 1)
    anchor = smallest((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), size - gram + 1)[:n] & mask
    length = np.diff(part.offsets)
    whole = np.flatnonzero(length >= size)
    valid = covered(part.offsets[whole], length[whole] - size + 1, n) if len(whole) else np.zeros(n, bool)
    fresh = np.ones(n, bool)
    fresh[1:] = anchor[1:] != anchor[:-1]
    fresh[part.offsets[whole]] = True
    fresh[1:] |= ~valid[:-1]
    fresh &= valid
    first = np.flatnonzero(fresh)
    stop = np.append(first[1:], n)
    text = np.searchsorted(part.offsets, first, side="right") - 1
    stop = np.minimum(stop, part.offsets[text + 1] - size + 1)
    return first, stop - first, grams[anchor[first].astype(np.int64)], text


class Batch:
    """The segments of a batch, slice by slice, and its distinct anchors."""

    def __init__(self, group: pa.Table, size: int, gram: int) -> None:
        self.size = size
        self.ids, self.rank = ranked(column(group, "doc_id"))
        self.parts = []
        for part in slices(column(group, "text")):
            first, n, anchor, text = segments(part, size, gram)
            known = self.rank[part.first + text] >= 0
            self.parts.append((part, first[known], n[known], anchor[known], self.rank[part.first + text[known]]))
        anchor = np.concatenate([p[3] for p in self.parts]) if self.parts else np.zeros(0, np.uint64)
        rank = np.concatenate([p[4] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        order = np.argsort(anchor)
        fresh = heads(anchor[order])
        at = np.flatnonzero(fresh)
        self.anchors = anchor[order][at]
        #: whether several documents of this batch have the anchor
        self.shared = (
            np.minimum.reduceat(rank[order], at) < np.maximum.reduceat(rank[order], at) if len(at) else np.zeros(0, bool)
        )

    def by_bucket(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        return by_bucket((self.anchors % np.uint64(buckets)).astype(np.int64))

    def repeated(self, answers: dict[int, bytes], buckets: int) -> None:
        """Notes which anchors occur in other batches."""
        for name, places in self.by_bucket(buckets):
            self.shared[places] |= flags_of(answers[name], len(places))

    def candidates(self) -> Iterator[tuple[Slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for part, first, n, anchor, rank in self.parts:
            keep = self.shared[np.searchsorted(self.anchors, anchor)] if len(anchor) else np.zeros(0, bool)
            yield part, first[keep], n[keep], anchor[keep], rank[keep]

    def distinct(self, buckets: int) -> dict[int, dict[bytes, int]]:
        """By bucket, the distinct candidate segments and the smallest rank of each."""
        found: dict[int, dict[bytes, int]] = {}
        for part, first, n, anchor, rank in self.candidates():
            data = part.data.tobytes()
            bucket = (anchor % np.uint64(buckets)).tolist()
            for a, b, k, r in zip(first.tolist(), (first + n + self.size - 1).tolist(), bucket, rank.tolist(), strict=True):
                mine = found.setdefault(k, {})
                text = data[a:b]
                if mine.get(text, r) >= r:
                    mine[text] = r
        return {k: dict(sorted(v.items())) for k, v in sorted(found.items())}


def ask_anchors(size: int, gram: int, buckets: int):
    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        batch = Batch(group, size, gram)
        return table(_ASKED, [(key[0].as_py(), 1, k, pack(gaps(batch.anchors[p]))) for k, p in batch.by_bucket(buckets)])

    return ask


def answer_anchors(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One bit for each anchor of each batch: whether another batch has it."""
    rows = blob_rows(group, "batch", "blob")
    lists = [np.cumsum(unpack(blob)[0]) for _, blob in rows]
    every = np.concatenate(lists)
    order = np.argsort(every)
    fresh = heads(every[order])
    count = np.diff(np.append(np.flatnonzero(fresh), len(every)))
    flags = np.zeros(len(every), bool)
    flags[order] = (count > 1)[np.cumsum(fresh) - 1]
    pieces = np.split(flags, np.cumsum([len(x) for x in lists])[:-1])
    bucket = key[0].as_py()
    return table(_ASKED, [(batch, 1, bucket, bits(piece)) for (batch, _), piece in zip(rows, pieces, strict=True)])


def ask_segments(size: int, gram: int, buckets: int, places: int):
    def ask(key: tuple[pa.Scalar, ...], group: pa.Table, answers: pa.Table) -> pa.Table:
        batch = Batch(group, size, gram)
        batch.repeated(dict(blob_rows(answers, "bucket", "blob")), buckets)
        rows = []
        for k, found in batch.distinct(places).items():
            ids, place = table_of(batch.ids, np.fromiter(found.values(), np.int64, len(found)))
            lengths = np.fromiter(map(len, found), np.uint16, len(found))
            rows.append((key[0].as_py(), 2, k, pack(lengths, place, gaps(ids), np.frombuffer(b"".join(found), np.uint8))))
        return table(_ASKED, rows)

    return ask


class SuffixArray:
    """The sorted suffixes of some distinct segments, as far as ``size`` bytes, and their common prefixes."""

    def __init__(self, texts: list[bytes], size: int) -> None:
        data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        strings = lengths - size + 1
        #: ``bounds[k]:bounds[k + 1]`` are the suffixes of segment ``k``
        self.bounds = np.concatenate(([0], np.cumsum(strings)))
        owner = np.repeat(np.arange(len(texts)), strings)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[owner] + np.arange(len(owner)) - self.bounds[owner]
        rows = np.lib.stride_tricks.sliding_window_view(data, size)[starts]
        self.order = np.argsort(rows.view(f"S{size}").reshape(-1), kind="stable")
        ordered = rows[self.order]
        #: whether a suffix shares fewer than ``size`` bytes with the one before it: an interval starts
        self.fresh = np.ones(len(ordered), bool)
        self.fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        self.owner = owner

    def lowest(self, ids: np.ndarray) -> np.ndarray:
        """For each suffix the smallest id in its interval at depth ``size``; ``ids`` are those of the segments."""
        least = np.minimum.reduceat(ids[self.owner[self.order]], np.flatnonzero(self.fresh))
        out = np.empty(len(self.order), ids.dtype)
        out[self.order] = least[np.cumsum(self.fresh) - 1]
        return out


def unpacked_segments(blob: bytes) -> tuple[list[bytes], np.ndarray]:
    lengths, place, ids, data = unpack(blob)
    raw, ends = data.tobytes(), np.cumsum(lengths.astype(np.int64))
    return [raw[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)], np.cumsum(ids)[place]


def answer_segments(size: int):
    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """One bit for each string of each segment: whether a document with a smaller id than the batch's has it."""
        rows = blob_rows(group, "batch", "blob")
        number: dict[bytes, int] = {}
        which, ids = [], []
        for _, blob in rows:
            texts, lowest = unpacked_segments(blob)
            which.append(np.fromiter((number.setdefault(t, len(number)) for t in texts), np.int64, len(texts)))
            ids.append(lowest)
        least = np.full(len(number), np.iinfo(np.int64).max)
        for k, lowest in zip(which, ids, strict=True):
            np.minimum.at(least, k, lowest)
        array = SuffixArray(list(number), size)
        smallest_id = array.lowest(least)
        out = []
        for (batch, _), k, lowest in zip(rows, which, ids, strict=True):
            at, n = array.bounds[k], array.bounds[k + 1] - array.bounds[k]
            spread = np.repeat(at - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            out.append((batch, 2, key[0].as_py(), bits(smallest_id[spread] < np.repeat(lowest, n))))
        return table(_ASKED, out)

    return answer


def removing(size: int, gram: int, buckets: int, places: int, digest: bool, with_bytes: bool):
    def remove(group: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
        for step, bucket, blob in blob_rows(answers, "step", "bucket", "blob"):
            found[step][bucket] = blob
        batch = Batch(group, size, gram)
        batch.repeated(found[1], buckets)
        known: dict[bytes, tuple[int, int]] = {}
        flags, done = [np.zeros(0, bool)], 0
        for k, mine in batch.distinct(places).items():
            n = sum(map(len, mine)) - len(mine) * (size - 1)
            flags.append(flags_of(found[2][k], n))
            for text, rank in mine.items():
                known[text] = done, rank
                done += len(text) - size + 1
        flag = np.concatenate(flags)
        ids, rows = column(group, "doc_id").to_pylist(), []
        for part, first, n, _, rank in batch.candidates():
            data = part.data.tobytes()
            pairs = [known[data[a:b]] for a, b in zip(first.tolist(), (first + n + size - 1).tolist(), strict=True)]
            at, lowest = np.array(pairs, np.int64).reshape(-1, 2).T
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = flag[np.repeat(at, n) + step] | np.repeat(rank > lowest, n)
            gone = covered((np.repeat(first, n) + step)[hit], size, len(data))
            for k, (lo, hi) in enumerate(zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True)):
                mine = gone[lo:hi]
                a, b = runs(mine)
                kept = part.data[lo:hi][~mine].tobytes() if len(a) else data[lo:hi]
                rows.append((
                    ids[part.first + k], hi - lo, int(mine.sum()), a, b,
                    hashlib.sha256(kept).hexdigest() if digest else None, kept if with_bytes else None,
                ))
        return table(_RESULT, rows)

    return remove


def repeats(
    documents: DataFrame, size: int = SIZE, gram: int = GRAM, digest: bool = True, with_bytes: bool = False,
    batch_bytes: int = BATCH_BYTES, anchor_bytes: int = ANCHOR_BYTES, segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Per document row: its bytes, how many are removed, the removed spans, and the rest as a digest or as bytes.

    ``anchor_bytes`` and ``segment_bytes`` are how much text a bucket of anchors or of segments stands for.
    """
    texts, total = dealt(documents, batch_bytes)
    buckets, places = parts_of(total, anchor_bytes), parts_of(total, segment_bytes)
    batches = texts.groupBy("batch")
    anchors = batches.applyInArrow(ask_anchors(size, gram, buckets), _SPARK_ASKED)
    known = anchors.groupBy("bucket").applyInArrow(answer_anchors, _SPARK_ASKED)
    asked = batches.cogroup(known.groupBy("batch")).applyInArrow(ask_segments(size, gram, buckets, places), _SPARK_ASKED)
    found = asked.groupBy("bucket").applyInArrow(answer_segments(size), _SPARK_ASKED)
    return batches.cogroup(known.unionByName(found).groupBy("batch")).applyInArrow(
        removing(size, gram, buckets, places, digest, with_bytes), _SPARK_RESULT
    )


def ask_occurrences(size: int, gram: int, buckets: int, places: int, depth: int):
    """Every occurrence of a candidate segment, with ``depth`` bytes from its last string on, and the byte before it."""

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table, answers: pa.Table) -> pa.Table:
        batch = Batch(group, size, gram)
        batch.repeated(dict(blob_rows(answers, "bucket", "blob")), buckets)
        rows = []
        for part, first, n, anchor, rank in batch.candidates():
            data = part.data.tobytes()
            text = np.searchsorted(part.offsets, first, side="right") - 1
            begin, end = part.offsets[text], part.offsets[text + 1]
            stop = np.minimum(first + n - 1 + depth, end)
            left = np.where(first > begin, part.data[np.maximum(first - 1, 0)].astype(np.int32), -1)
            for k, places_here in by_bucket((anchor % np.uint64(places)).astype(np.int64)):
                texts = [data[first[i] : stop[i]] for i in places_here]
                rows.append((key[0].as_py(), 3, k, pack(
                    (stop - first)[places_here], n[places_here], left[places_here], batch.ids[rank[places_here]],
                    (first - begin)[places_here], np.frombuffer(b"".join(texts), np.uint8),
                )))
        return table(_ASKED, rows)

    return ask


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def intervals(prefixes: list[int], lefts: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Depth, first and last place of the intervals of depth ``least`` or more whose left bytes differ.

    ``prefixes[i]`` is what place ``i`` has in common with the one before it, ``lefts`` are the bytes to the left. The
    stack holds the open intervals with the left bytes seen in them; a closed one hands its bytes to the one around it.
    """
    stack: list[tuple[int, int, set[int]]] = []
    for place in range(1, len(prefixes) + 1):
        depth = prefixes[place] if place < len(prefixes) else 0
        first, seen = place - 1, {lefts[place - 1]}
        while stack and stack[-1][0] > depth:
            top, first, inside = stack.pop()
            seen |= inside
            if len(seen) > 1:
                yield top, first, place - 1
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2].update(seen)
            else:
                stack.append((depth, first, seen))


def groups(size: int, depth: int):
    def group_rows(table_: pa.Table) -> pa.Table:
        found = []
        for (blob,) in blob_rows(table_, "blob"):
            length, n, left, ids, starts, data = unpack(blob)
            raw, end = data.tobytes(), np.cumsum(length)
            for a, b, m, c, i, s in zip(*(x.tolist() for x in (end - length, end, n, left, ids, starts)), strict=True):
                for k in range(m):
                    found.append((raw[a + k : min(b, a + k + depth)], i, s + k, raw[a + k - 1] if k else c))
        found.sort()
        # the start of a text is like no other byte
        lefts = [-1 - k if x[3] < 0 else x[3] for k, x in enumerate(found)]
        prefixes = [0, *(common(x[0], y[0]) for x, y in zip(found, found[1:], strict=False))]
        rows = []
        for deep, lo, hi in intervals(prefixes, lefts, size):
            if len({x[1] for x in found[lo : hi + 1]}) > 1:
                rows += [(found[lo][0][:deep], deep, deep == depth, x[1], x[2]) for x in found[lo : hi + 1]]
        return table(
            {"repeat": pa.binary(), "n_bytes": pa.int32(), "cut": pa.bool_(), "doc_id": pa.int64(), "start": pa.int64()}, rows
        )

    return group_rows


def maximal_repeats(
    documents: DataFrame, size: int = SIZE, gram: int = GRAM, depth: int = 4 * SIZE, batch_bytes: int = BATCH_BYTES,
    anchor_bytes: int = ANCHOR_BYTES, segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """A row for each occurrence of each maximal repeat of ``size`` bytes or more that several documents share.

    ``start`` is the byte at which it starts. What is longer than ``depth`` is reported at that depth, as ``cut``.
    """
    texts, total = dealt(documents, batch_bytes)
    buckets, places = parts_of(total, anchor_bytes), parts_of(total, segment_bytes)
    batches = texts.groupBy("batch")
    anchors = batches.applyInArrow(ask_anchors(size, gram, buckets), _SPARK_ASKED)
    known = anchors.groupBy("bucket").applyInArrow(answer_anchors, _SPARK_ASKED)
    asked = batches.cogroup(known.groupBy("batch")).applyInArrow(ask_occurrences(size, gram, buckets, places, depth), _SPARK_ASKED)
    return asked.groupBy("bucket").applyInArrow(
        groups(size, depth), "repeat binary, n_bytes int, cut boolean, doc_id long, start long"
    )


def report(documents: DataFrame) -> DataFrame:
    return repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256"
    )
