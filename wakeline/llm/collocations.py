"""Phrases whose words stand together more often than apart.

Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs. A phrase of up to
``LONGEST`` words is a candidate if it occurs ``LEAST`` times within pieces of its language. Its score compares its
count with what its two parts would give by chance, at the cut where that is least.

A phrase cannot occur more often than any phrase in it, so candidates are narrowed from few words to many:

1. Words are counted: per task first, then per language.
2. Pairs of two frequent words are summed, then phrases of three and more words whose pairs are all frequent. What stays
   below ``LEAST`` cannot be a candidate.
3. The phrases that are left are the candidates, in shards of up to ``SHARD_PHRASES``. Each shard becomes a
   double-array trie, built in a task and broadcast. A pass over the corpus moves the states of all positions at
   once, level by level, and counts accepting states by ``bincount``; the arrays of all tasks are summed in two steps.

Frequent words and pairs reach the tasks as a bitmap of hashes of up to ``2 ** MOST_BITS`` bits. Where it fills up, it only
lets more phrases through to the sums, so results do not depend on its size. A corpus with more candidates than a
shard holds takes one pass a shard.

Words are named by a 64-bit hash with their language. Among a million frequent words two share a name with a probability of
3e-8; a rare word is taken for one of them with 5e-14.

Defined cases: null and empty texts have no words, and a table without words no rows. A null language is
``und``, together with documents that say so. Rows that repeat an id, or lack one, count like all others. Texts are
never cut: a task holds the longest one. Only the columns of text and language are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.double_array import DoubleArray
from wakeline.llm.rows import parts_of, small_batches
from wakeline.llm.text import SPACED, Slice, column, gram_hash, mix, pack, slices, unpack
from wakeline.session import materialise

LONGEST = 5
LEAST = 100
TOP = 2000
SHARD_PHRASES = 500_000
MOST_BITS = 28
STRETCH = 1 << 14
SUMS = 64
PART_BYTES = 1 << 20

KEYS = tuple(f"k{k}" for k in range(1, LONGEST + 1))

#: Bytes that end a piece, and those that belong to words: all but these, space and tab.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = SPACED & ~ENDS


class Spoken:
    """The words of a slice in lower case, with the piece each one stands in and a key of word and language.

    Hashing needs some numbers a byte, so a worker's memory follows the slice; what the slices of a task have in common is
    summed by Spark before it is shuffled.
    """

    def __init__(self, part: Slice, langs: list[str]) -> None:
        self.part = part.lowered()
        self.words = self.part.words(WORD)
        self.langs = langs
        salt = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        salts = np.array([salt[x] for x in langs], np.uint64)
        self.keys = mix(self.words.hashes ^ salts[self.words.text])
        self.piece = np.searchsorted(np.flatnonzero(ENDS[self.part.data]), self.words.start) + self.words.text

    def windows(self, size: int, among: np.ndarray | None = None) -> np.ndarray:
        """Where ``size`` words of one piece start; ``among`` narrows the starts."""
        at = np.arange(len(self.words)) if among is None else among
        at = at[at + size <= len(self.words)]
        return at[self.piece[at + size - 1] == self.piece[at]]

    def gram_keys(self, at: np.ndarray, size: int) -> np.ndarray:
        return gram_hash(self.keys, at, size) if size > 1 else self.keys[at]

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The words from each place on, joined by a space."""
        data = self.part.data.tobytes()
        start, end = self.words.start, self.words.end
        return pa.array([
            " ".join(data[start[p + k] : end[p + k]].decode("utf-8", "replace") for k in range(size)) for p in at.tolist()
        ], pa.string())

    def lang_of(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.langs[k] for k in self.words.text[at].tolist()], pa.string())


def spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[Spoken]:
    for batch in batches:
        langs = column(batch, "lang").to_pylist()
        for part in slices(column(batch, "text"), PART_BYTES):
            yield Spoken(part, langs[part.first : part.first + part.n])


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in spoken(batches):
        keys, at, n = np.unique(s.keys, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [s.lang_of(at), s.phrases(at, 1), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "phrase", "key", "n"]
        )


def pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = np.stack([column(batch, k).to_numpy() for k in KEYS[:2]], axis=1).reshape(-1).view(np.uint64)
        keys = gram_hash(words, np.arange(0, len(words), 2), 2)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


class Bitmap:
    """A set of keys by their first bits: has all of them, and some others if it is full."""

    def __init__(self, bits: int, flags: np.ndarray) -> None:
        self.bits, self.flags = bits, flags

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(64 - self.bits)
        return (self.flags[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    @classmethod
    def of(cls, keys: DataFrame, n: int) -> Bitmap:
        """Of the column ``key`` with ``n`` rows; tasks build stretches of 128 kB, and only the bitmap is collected."""
        bits = min(MOST_BITS, max(20, (256 * n).bit_length()))
        slots = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("slot")).select(F.shiftright("slot", 20).alias("stretch"), "slot").distinct()

        def stretch(table: pa.Table) -> pa.Table:
            slot = column(table, "slot").to_numpy()
            flags = np.zeros(1 << 20, bool)
            flags[slot & ((1 << 20) - 1)] = True
            return pa.table({"stretch": pa.array([int(slot[0]) >> 20], pa.int64()), "flags": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

        flags = np.zeros(1 << (bits - 3), np.uint8)
        for row in slots.groupBy("stretch").applyInArrow(stretch, "stretch long, flags binary").toLocalIterator():
            flags[row["stretch"] << 17 : (row["stretch"] + 1) << 17] = np.frombuffer(row["flags"], np.uint8)
        return cls(bits, flags)


def summed(sizes: tuple[int, ...], within: Bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The keys of the words, and ``n``, of phrases of these sizes: of two words that are ``within``, or whose pairs all are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in spoken(batches):
            step = 1 if sizes[0] == 2 else 2
            at = s.windows(step)
            good = np.zeros(len(s.words) + 1, bool)
            good[at[within.has(s.gram_keys(at, step))]] = True
            for size in sizes:
                at = s.windows(size, np.flatnonzero(good[:-1]))
                for k in range(1, size - step + 1):
                    at = at[good[at + k]]
                _, first, n = np.unique(s.gram_keys(at, size), return_index=True, return_counts=True)
                keys = [pa.array(s.keys[at[first] + k].view(np.int64)) for k in range(size)]
                keys += [pa.nulls(len(first), pa.int64())] * (sizes[-1] - size)
                yield pa.RecordBatch.from_arrays([*keys, pa.array(n)], [*KEYS[: sizes[-1]], "n"])

    return run


def trie_of(table: pa.Table) -> pa.Table:
    """One shard's candidates, numbered by ``place``, as a double-array trie."""
    table = table.sort_by("place")
    lists = [column(table, k) for k in KEYS]
    lengths = sum(x.is_valid().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
    keys = np.stack([x.fill_null(0).to_numpy().view(np.uint64) for x in lists], axis=1)
    shard = column(table, "shard").slice(0, 1)
    return pa.table({"shard": shard, "trie": pa.array([DoubleArray.build(keys, lengths).to_bytes()], pa.binary())})


def counted_by(blob: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``stretch, counts``: how often each sequence of a trie occurs in all batches of a task, in stretches of ``STRETCH``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = DoubleArray.from_bytes(blob), np.zeros(0, np.int64)
        for s in spoken(batches):
            n = trie.counts(trie.symbols(s.keys), s.piece, LONGEST)
            total = total + n if len(total) else n
        parts = [total[lo : lo + STRETCH] for lo in range(0, len(total), STRETCH)]
        rows = [(k, pack(x)) for k, x in enumerate(parts) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["stretch", "counts"])

    return run


def added(table: pa.Table) -> pa.Table:
    """One stretch of the sums of several tasks."""
    total = sum(unpack(x)[0] for x in column(table, "counts").to_pylist())
    return pa.table({"stretch": column(table, "stretch").slice(0, 1), "counts": pa.array([pack(total)], pa.binary())})


def unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, blob in zip(column(batch, "stretch").to_pylist(), column(batch, "counts").to_pylist(), strict=True):
            n = unpack(blob)[0]
            yield pa.RecordBatch.from_arrays([pa.array(k * STRETCH + np.arange(len(n))), pa.array(n)], ["place", "n"])


def trie_counts(texts: DataFrame, blob: bytes) -> DataFrame:
    """``place, n``: the arrays of all tasks summed, first those of every ``SUMS``-th task, then the sums."""
    rows = texts.mapInArrow(counted_by(blob), "stretch int, counts binary").withColumn("some", F.pmod(F.spark_partition_id(), F.lit(SUMS)))
    rows = rows.groupBy("stretch", "some").applyInArrow(added, "stretch int, counts binary")
    return rows.groupBy("stretch").applyInArrow(added, "stretch int, counts binary").mapInArrow(unfolded, "place long, n long")


def candidates(texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``shard, place`` and the words' keys of every phrase of two words and more that may occur ``least`` times."""

    def frequent(sizes: tuple[int, ...], within: Bitmap) -> DataFrame:
        keys = KEYS[: sizes[-1]]
        rows = texts.mapInArrow(summed(sizes, within), ", ".join(f"{k} long" for k in (*keys, "n")))
        return materialise(rows.groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).drop("n"), "phrase-keys")

    pairs = frequent((2,), Bitmap.of(words, words.count()))
    named = pairs.mapInArrow(pair_keys, "key long")
    longer = frequent(tuple(range(3, LONGEST + 1)), Bitmap.of(named, pairs.count()))
    rows = pairs.unionByName(longer, allowMissingColumns=True)
    shard = F.pmod(F.xxhash64(*KEYS), F.lit(parts_of(rows.count(), SHARD_PHRASES))).cast("int").alias("shard")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(*KEYS)) - 1
    return materialise(rows.select(shard, *KEYS).withColumn("place", place.cast("long")), "candidates")


def counted(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of all phrases that occur ``least`` times, and ``lang, total`` words of each language."""
    words = texts.mapInArrow(counted_words, "lang string, phrase string, key long, n long")
    words = materialise(words.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("key").alias("key")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    words = words.filter(F.col("n") >= least)
    some = candidates(texts, words, least)
    tries = materialise(some.groupBy("shard").applyInArrow(trie_of, "shard int, trie binary"), "tries")
    shards = some.agg(F.max("shard")).first()[0]
    counts = some.select("shard", "place", F.lit(0).cast("long").alias("n")).limit(0)
    for shard in range(0 if shards is None else shards + 1):
        blob = tries.filter(F.col("shard") == shard).first()
        if blob is None:
            continue
        mine = trie_counts(texts, blob["trie"]).filter(F.col("n") >= least).select(F.lit(shard).alias("shard"), "place", "n")
        counts = counts.unionByName(materialise(mine, "phrase-counts"))
    # keys become words again
    known = some.join(counts, ["shard", "place"]).select("shard", "place", "n", F.posexplode(F.array(*KEYS)).alias("at", "key")).filter("key is not null")
    known = known.join(words.select("key", "lang", F.col("phrase").alias("word")), "key").groupBy("shard", "place").agg(
        F.first("lang").alias("lang"), F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")
    )
    known = known.select("lang", F.array_join("w.word", " ").alias("phrase"), F.size("w").alias("size"), "n")
    known = known.unionByName(words.select("lang", "phrase", F.lit(1).alias("size"), "n"))
    return materialise(known, "known-phrases"), totals


def collocations(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    texts = small_batches(documents.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    ))
    known, totals = counted(texts, least)
    words = F.split("phrase", " ")
    whole = known.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    # a part of a candidate occurs at least as often, so its count is among the known ones
    cuts = whole.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "total", "l", "r")}
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["total"])).withColumn("under", wide["l"] * wide["r"])
    scored = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("total").alias("n")
    )
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("size") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " ")),
    ))
    inside = whole.filter("size > 2").select("lang", "a", F.explode(spans).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    free = scored.join(inside, ["lang", "phrase"], "left").filter("most is null or 100 * most < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = free.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return rows.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
