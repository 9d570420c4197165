"""Benchmark decontamination by winnowing.

A window is ``size`` consecutive words. Both sides choose one fingerprint for each window: the smallest hash of the
``gram``-word sequences in it. Equal windows choose equal fingerprints, so looking up the fingerprints of the documents
among those of the benchmark finds every shared window; whatever is found is then extended and compared word by word.
An item of fewer words than ``size``, but not none, is one window of its own length and is looked up as a whole.

A benchmark of at most ``block_bytes`` of text (Spark sums them first) is an index in memory that travels to the tasks; the
documents are not shuffled. A larger one is joined: its windows with their fingerprints are rows, a bitmap of fixed size that
Spark builds of the fingerprints tells which windows of the documents may be among them, and these windows meet on
fingerprint and words, each once for a text however often it is there. Neither the driver nor a task then holds the benchmark.
Fingerprints that many documents share are dealt to ``SALTS`` places. Both ways give the same result.

Defined cases: a null or empty text has no words and no hits; a document or item without words never matches; items
without an id are left out; items that repeat an id count once; a document row that repeats has a result row each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.rows import free_name, small_batches, text_bytes
from wakeline.llm.text import ALNUM, Slice, Words, column, covered, gram_hash, mix, runs, slices
from wakeline.session import materialise

SIZE, GRAM = 10, 5
BLOCK_BYTES = 4 << 20
BITS = 26
SALTS = 8

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
])


def smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    done, low = 1, grams
    while done < width:
        step = min(done, width - done)
        low = np.minimum(low[: len(low) - step], low[step:])
        done += step
    return low


def chosen(hashes: np.ndarray, at: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The fingerprint of each window that starts at a word in ``at``."""
    if len(at) == 0:
        return np.zeros(0, np.uint64)
    grams = gram_hash(hashes, np.arange(len(hashes) - gram + 1), gram, seed=7)
    return smallest(grams, size - gram + 1)[at]


class Index:
    """The windows of one block of items: by length, sorted fingerprints, window hashes and their words."""

    def __init__(self, ids: list[str], texts: list[str], size: int, gram: int) -> None:
        self.size, self.gram, self.ids = size, gram, ids
        found: dict[tuple[int, int], dict[bytes, list[int]]] = {}
        marks: list[np.ndarray] = []
        for part in slices(pa.array(texts, pa.large_string())):
            part = part.lowered()
            words = part.words(ALNUM)
            for length in {size, *np.unique(words.counts[(words.counts > 0) & (words.counts < size)]).tolist()}:
                at = words.windows(length)
                at = at if length == size else at[words.counts[words.text[at]] == length]
                if length == size:
                    marks.append(chosen(words.hashes, at, size, gram))
                for w, h in zip(at.tolist(), words.fingerprints(at, length).tolist(), strict=True):
                    owners = found.setdefault((length, h), {}).setdefault(spelled(words, w, length), [])
                    item = part.first + int(words.text[w])
                    if item not in owners:
                        owners.append(item)
        self.marks = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.uint64)
        self.found = found
        self.lengths = sorted({length for length, _ in found})
        self.hashes = {n: np.array(sorted(h for length, h in found if length == n), np.uint64) for n in self.lengths}


def spelled(words, at: int, length: int) -> bytes:
    data, start, end = words.part.data, words.start, words.end
    return b" ".join(data[start[k] : end[k]].tobytes() for k in range(at, at + length))


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values


def hits(part: Slice, index: Index) -> tuple[np.ndarray, list[tuple[int, int, int]], list[set[str]]]:
    """Words per text, hit spans as (text, first word, word after the last), and the items of each text."""
    words = part.lowered().words(ALNUM)
    hit = np.zeros(len(words), bool)
    items: list[set[str]] = [set() for _ in range(part.n)]
    for length in index.lengths:
        at = words.windows(length)
        if length == index.size:
            at = at[among(chosen(words.hashes, at, length, index.gram), index.marks)]
        prints = words.fingerprints(at, length)
        match = among(prints, index.hashes[length])
        real = []
        for w, h in zip(at[match].tolist(), prints[match].tolist(), strict=True):
            owners = index.found[length, h].get(spelled(words, w, length))
            if owners:
                real.append(w)
                items[words.text[w]].update(index.ids[x] for x in owners)
        if real:
            hit |= covered(np.array(real), length, len(words))
    spans = []
    for k in np.flatnonzero([bool(x) for x in items]):
        lo, hi = words.first[k], words.first[k + 1]
        spans += [(int(k), int(a), int(b)) for a, b in zip(*runs(hit[lo:hi]), strict=True)]
    return words.counts, spans, items


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scanner(index: Index, text_col: str, result: str, keep: list[str]):
    """A pass over Arrow batches that adds the ``result`` column."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part in slices(column(batch, text_col)):
                counts, spans, items = hits(part, index)
                places: list[list[tuple[int, int]]] = [[] for _ in range(part.n)]
                for k, a, b in spans:
                    places[k].append((a, b))
                for k in range(part.n):
                    rows.append({
                        "n_words": int(counts[k]), "starts": [a for a, _ in places[k]], "ends": [b for _, b in places[k]],
                        "items": sorted(items[k]),
                    })
            columns = [column(batch, name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, _ARROW)], [*keep, result])

    return scan


_WINDOW = pa.schema([("length", pa.int32()), ("mark", pa.int64()), ("spelling", pa.binary())])


def marked(words: Words, length: int, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of ``length`` words start, and the fingerprint of each."""
    at = words.windows(length)
    return at, chosen(words.hashes, at, size, gram) if length == size else words.fingerprints(at, length)


def bits_of(marks: np.ndarray, length: int) -> np.ndarray:
    """The place of each fingerprint in the bitmap."""
    return (mix(marks + np.uint64(length)) >> np.uint64(64 - BITS)).astype(np.int64)


def item_windows(size: int, gram: int):
    """A pass over items (id, text) that lists their windows: length, fingerprint, words, bit, item."""
    schema = pa.schema([*_WINDOW, ("bit", pa.int64()), ("item", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "id").to_pylist()
            for part in slices(column(batch, "text")):
                words = part.lowered().words(ALNUM)
                short = np.unique(words.counts[(words.counts > 0) & (words.counts < size)]).tolist()
                for length in [*short, size]:
                    at, marks = marked(words, length, size, gram)
                    if length < size:
                        whole = words.counts[words.text[at]] == length
                        at, marks = at[whole], marks[whole]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), length, np.int32)), pa.array(marks.view(np.int64)),
                        pa.array([spelled(words, w, length) for w in at.tolist()], pa.binary()), pa.array(bits_of(marks, length)),
                        pa.array([ids[part.first + k] for k in words.text[at].tolist()], pa.string()),
                    ], schema=schema)

    return scan


def candidates(bitmap: np.ndarray, lengths: list[int], size: int, gram: int):
    """A pass over texts (key, text) that lists the windows whose fingerprint is in the bitmap, each once a text with its places."""
    schema = pa.schema([("key", pa.string()), *_WINDOW, ("starts", pa.list_(pa.int32()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = column(batch, "key").to_pylist()
            for part in slices(column(batch, "text")):
                words = part.lowered().words(ALNUM)
                for length in lengths:
                    at, marks = marked(words, length, size, gram)
                    bit = bits_of(marks, length)
                    may = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                    places: dict[tuple[int, int, bytes], list[int]] = {}
                    for w, mark in zip(at[may].tolist(), marks[may].view(np.int64).tolist(), strict=True):
                        text = int(words.text[w])
                        places.setdefault((text, mark, spelled(words, w, length)), []).append(w - int(words.first[text]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([keys[part.first + text] for text, _, _ in places], pa.string()),
                        pa.array(np.full(len(places), length, np.int32)), pa.array([mark for _, mark, _ in places], pa.int64()),
                        pa.array([window for _, _, window in places], pa.binary()),
                        pa.array(list(places.values()), pa.list_(pa.int32())),
                    ], schema=schema)

    return scan


def bitmap_of(windows: DataFrame) -> np.ndarray:
    """Which bits the windows have: 8 MB, whatever their number."""
    place = F.col("bit") + 1
    parts = windows.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in parts:
        at = (r["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, hits, items) with the hits united to spans."""
    for batch in batches:
        spans = [
            united([(a, a + hit["length"]) for hit in found for a in hit["starts"]]) for found in column(batch, "hits").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([
            column(batch, "key"), pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int32())),
            pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int32())), column(batch, "items"),
        ], ["key", "starts", "ends", "items"])


def found_texts(texts: DataFrame, items: DataFrame, size: int, gram: int) -> DataFrame:
    """``key, starts, ends, items`` of the texts (key, text) that share a window with an item (id, text); a row a key."""
    on = ["length", "mark", "spelling"]
    windows = materialise(
        small_batches(items).mapInArrow(item_windows(size, gram), "length int, mark long, spelling binary, bit long, item string").distinct(),
        "benchmark-windows",
    )
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]  # at most ``size`` of them
    seen = small_batches(texts).mapInArrow(
        candidates(bitmap_of(windows), sorted(lengths), size, gram), "key string, length int, mark long, spelling binary, starts array<int>")
    # copies of a text have the same places
    seen = seen.groupBy("key", *on).agg(F.first("starts").alias("starts"))
    seen = materialise(seen.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))), "candidate-windows")
    dealt = windows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    where = seen.join(dealt.select(*on, "salt"), [*on, "salt"], "left_semi").groupBy("key").agg(
        F.collect_list(F.struct("length", "starts")).alias("hits"))
    whose = seen.join(dealt, [*on, "salt"]).select("key", "item").distinct().groupBy("key").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    return where.join(whose, "key").select("key", "hits", "items").mapInArrow(
        spans_of, "key string, starts array<int>, ends array<int>, items array<string>")


def counter(text_col: str, count: str, keep: list[str]):
    """A pass that adds the number of words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [part.lowered().words(ALNUM).counts for part in slices(column(batch, text_col))]
            n = np.concatenate(counts) if counts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(column(batch, name) for name in keep), pa.array(n.astype(np.int64))], [*keep, count])

    return scan


def annotate(
    documents: DataFrame, benchmark: DataFrame, result: str = "contamination", keep: list[str] | None = None,
    text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``documents`` with a struct ``result``: number of words, spans of hit words (start, end), ids of matching items.

    ``keep`` names the columns to return (all of them by default). ``result`` must not be a column of ``documents``.
    """
    if result.lower() in {c.lower() for c in documents.columns}:
        raise ValueError(f"documents has a column {result}; choose another result name")
    keep = list(documents.columns if keep is None else keep)
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text")).dropna()
    if text_bytes(items) <= block_bytes:
        held = items.collect()
        index = Index([r["id"] for r in held], [r["text"] for r in held], size, gram)
        schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField(result, RESULT)])
        return small_batches(documents).mapInArrow(scanner(index, text_col, result, keep), schema)
    # copies of a text are one key; the key is made of the text, so that a task that runs again makes the same
    text_key = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    found = found_texts(documents.select(text_key.alias("key"), F.col(text_col).alias("text")), items, size, gram)
    key = free_name("text_key", *documents.columns, result)
    count = free_name("word_count", *documents.columns, result, key)
    columns = documents.withColumn(key, text_key)
    names = [*keep, key]
    schema = T.StructType([*(columns.schema[c] for c in names), T.StructField(count, T.LongType())])
    counted = small_batches(columns).mapInArrow(counter(text_col, count, names), schema)
    hit = free_name("hit", *documents.columns, result, key, count)
    matched = counted.join(found.select(F.col("key").alias(key), F.struct("starts", "ends", "items").alias(hit)), key, "left")
    none = {"starts": "array<int>", "ends": "array<int>", "items": "array<string>"}
    lists = [F.coalesce(F.col(hit)[n], F.array().cast(kind)).alias(n) for n, kind in none.items()]
    return matched.select(*keep, F.struct(F.col(count).alias("n_words"), *lists).alias(result))


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, all columns as they are."""
    result = free_name("contamination", *documents.columns)
    return annotate(documents, benchmark, result).filter(F.size(F.col(result)["starts"]) == 0).drop(result)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: how many of its words are hit, and by which items."""
    scanned = annotate(documents.select("doc_id", "text"), benchmark, keep=["doc_id"])
    found = F.col("contamination")
    n_hit = F.aggregate(
        F.zip_with(found["ends"], found["starts"], lambda b, a: (b - a).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return scanned.select(
        "doc_id", found["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(found["items"]), ","), 256).alias("items_sha256"),
        (F.size(found["starts"]) > 0).alias("contaminated"),
    )
