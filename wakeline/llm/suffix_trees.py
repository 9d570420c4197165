"""Repeated passages of words, by prefix-partitioned suffix trees.

Every word starts a suffix of its document. Suffixes go to groups by a prefix of variable length: one word if few
suffixes of the corpus start with it, else two words, else four, else the whole window, so that a group holds at most
about ``GROUP_ITEMS`` suffixes. How many suffixes share a prefix is counted over all documents, in a table of fixed size
whose slots can only overestimate. Groups are packed into buckets, and a task builds the part of the suffix tree below
them as far as it matters: the nodes ``SIZE`` words deep. A node's leaves are all suffixes that start with the same
window; a leaf whose node has a leaf in a document with a smaller id is a repeat. Neighbouring repeats of a document
join to spans: the maximal repeats.

A node is named by a 64-bit hash of its window, and is looked up within a bucket that was chosen by other hashes, so
with the data also the number of bits grows that two windows must agree in.

Defined cases: null and empty texts have no words; texts shorter than a window lose nothing; rows without an id
neither lose words nor count as an earlier document; rows that repeat an id do not remove one another's words, and
each has its result row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.exchange import BATCH_BYTES, bits, blob_rows, by_bucket, dealt, flags_of, heads, ranked, table, table_of
from wakeline.llm.rows import parts_of
from wakeline.llm.text import SPACED, Slice, Words, column, covered, gaps, mix, pack, runs, slices, unpack

SIZE = 13
GROUP_ITEMS = 1_000_000
PREFIXES = (1, 2, 4)
SLOTS = 1 << 12
#: No language has shorter words on average; only the number of buckets depends on it.
BYTES_PER_WORD = 6

_ASKED = {"batch": pa.int32(), "bucket": pa.int32(), "blob": pa.binary()}
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("starts", pa.list_(pa.int32())),
    ("ends", pa.list_(pa.int32())), ("kept_sha256", pa.string()), ("kept_text", pa.string()),
])
_SPARK_RESULT = (
    "doc_id long, n_words long, n_removed long, starts array<int>, ends array<int>, kept_sha256 string, kept_text string"
)


def counter(size: int):
    """Counts of suffixes by prefix length and slot, a task's total at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(PREFIXES), SLOTS), np.int64)
        for batch in batches:
            for part in slices(column(batch, "text")):
                words = part.words(SPACED)
                at = words.windows(size)
                for k, n in enumerate(PREFIXES):
                    total[k] += np.bincount(slots_of(words.fingerprints(at, n, 60 + n)), minlength=SLOTS)
        length, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(slot), pa.array(total[length, slot])], ["length", "slot", "n"])

    return count


def slots_of(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(52)).astype(np.int64)


def prefix_counts(texts: DataFrame, size: int) -> np.ndarray:
    """A table of ``len(PREFIXES) * SLOTS`` counts, whatever the corpus."""
    rows = (
        texts.select("text").mapInArrow(counter(size), "length long, slot long, n long")
        .groupBy("length", "slot").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros((len(PREFIXES), SLOTS), np.int64)
    for r in rows:
        out[r["length"], r["slot"]] = r["n"]
    return out


def buckets_of(words: Words, at: np.ndarray, size: int, fits: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each suffix: that of its shortest prefix whose group fits."""
    name = words.fingerprints(at, size, 60 + size)
    todo = np.ones(len(at), bool)
    for k, n in enumerate(PREFIXES):
        prints = words.fingerprints(at, n, 60 + n)
        done = todo & fits[k][slots_of(prints)]
        name[done] = mix(prints[done] + np.uint64(n))
        todo &= ~done
    return (name % np.uint64(buckets)).astype(np.int64)


class Leaves:
    """The suffixes of one batch, and the distinct nodes they hang on."""

    def __init__(self, group: pa.Table, size: int, fits: np.ndarray, buckets: int) -> None:
        ids = column(group, "doc_id")
        self.ids, rank = ranked(ids)
        prints, bucket, ranks, self.parts = [], [], [], []
        for part in slices(column(group, "text")):
            words = part.words(SPACED)
            at = words.windows(size)
            at = at[rank[part.first + words.text[at]] >= 0]
            prints.append(words.fingerprints(at, size))
            bucket.append(buckets_of(words, at, size, fits, buckets))
            ranks.append(rank[part.first + words.text[at]])
            self.parts.append((part, words.first, at))
        every = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        self.ranks = np.concatenate(ranks) if ranks else np.zeros(0, np.int64)
        self.order = np.argsort(every)
        ordered = every[self.order]
        fresh = heads(ordered)
        self.node_of = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        self.nodes = ordered[first]
        self.lowest = np.minimum.reduceat(self.ranks[self.order], first) if len(first) else np.zeros(0, np.int64)
        self.by_bucket = by_bucket(np.concatenate(bucket)[self.order[first]]) if len(first) else []

    def repeats(self, answers: dict[int, bytes]) -> Iterator[tuple[Slice, np.ndarray, np.ndarray]]:
        """For each slice of the batch, the bounds of its texts among the words and the words at which a repeat starts."""
        elsewhere = np.zeros(len(self.nodes), bool)
        for name, places in self.by_bucket:
            elsewhere[places] = flags_of(answers[name], len(places))
        hit = np.zeros(len(self.order), bool)
        hit[self.order] = elsewhere[self.node_of] | (self.ranks[self.order] > self.lowest[self.node_of])
        done = 0
        for part, first, at in self.parts:
            yield part, first, at[hit[done : done + len(at)]]
            done += len(at)


def asking(size: int, fits: np.ndarray, buckets: int):
    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        leaves = Leaves(group, size, fits, buckets)
        rows = []
        for name, places in leaves.by_bucket:
            ids, place = table_of(leaves.ids, leaves.lowest[places])
            rows.append((key[0].as_py(), name, pack(gaps(leaves.nodes[places]), gaps(ids), place)))
        return table(_ASKED, rows)

    return ask


def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One bit for each node of each batch: whether a document of another batch with a smaller id has it."""
    rows = blob_rows(group, "batch", "blob")
    nodes, lowest = [], []
    for _, blob in rows:
        steps, ids, place = unpack(blob)
        nodes.append(np.cumsum(steps))
        lowest.append(np.cumsum(ids)[place])
    every, ids = np.concatenate(nodes), np.concatenate(lowest)
    order = np.argsort(every)
    fresh = heads(every[order])
    least = np.minimum.reduceat(ids[order], np.flatnonzero(fresh))
    flags = np.zeros(len(every), bool)
    flags[order] = least[np.cumsum(fresh) - 1] < ids[order]
    ends = np.cumsum([len(n) for n in nodes])
    pieces = np.split(flags, ends[:-1])
    bucket = key[0].as_py()
    return table(_ASKED, [(batch, bucket, bits(piece)) for (batch, _), piece in zip(rows, pieces, strict=True)])


def removing(size: int, fits: np.ndarray, buckets: int, digest: bool, with_text: bool):
    def remove(group: pa.Table, answers: pa.Table) -> pa.Table:
        found = dict(blob_rows(answers, "bucket", "blob"))
        ids, rows = column(group, "doc_id").to_pylist(), []
        for part, first, starts in Leaves(group, size, fits, buckets).repeats(found):
            gone = covered(starts, size, int(first[-1]))
            for k in range(part.n):
                words = part.data[part.offsets[k] : part.offsets[k + 1]].tobytes().split()
                mine = gone[first[k] : first[k + 1]]
                lo, hi = runs(mine)
                kept = b" ".join(compress(words, ~mine)) if len(lo) else b" ".join(words)
                rows.append((
                    ids[part.first + k], len(words), int(mine.sum()), lo, hi,
                    hashlib.sha256(kept).hexdigest() if digest else None, kept.decode() if with_text else None,
                ))
        return table(dict(zip(_RESULT.names, _RESULT.types, strict=True)), rows)

    return remove


def repeats(
    documents: DataFrame, size: int = SIZE, digest: bool = True, with_text: bool = False, group_items: int = GROUP_ITEMS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per document row: its words, how many are removed, the removed spans, and the rest as a digest or as text."""
    texts, total = dealt(documents, batch_bytes)
    fits = prefix_counts(texts, size) <= group_items
    buckets = parts_of(total, group_items * BYTES_PER_WORD)
    asked = texts.groupBy("batch").applyInArrow(asking(size, fits, buckets), "batch int, bucket int, blob binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "batch int, bucket int, blob binary")
    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        removing(size, fits, buckets, digest, with_text), _SPARK_RESULT
    )


def report(documents: DataFrame) -> DataFrame:
    return repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("starts").cast("long").alias("n_spans"))
