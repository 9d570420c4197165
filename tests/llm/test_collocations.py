"""Collocations against counting phrases one by one; the trie against a dictionary."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import collocations
from wakeline.llm.collocations import Bitmap, counted_words, summed
from wakeline.llm.double_array import DoubleArray

RESULT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows, least, top):
    count, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for p in range(len(words) - size + 1):
                    key = lang, tuple(words[p : p + size])
                    count[key] = count.get(key, 0) + 1
    some = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    lost = set()
    for (lang, w), a in some.items():
        for size in range(2, len(w)):
            for p in range(len(w) - size + 1):
                if 100 * a >= 100 * some[lang, w[p : p + size]]:
                    lost.add((lang, w[p : p + size]))
    out = []
    for lang in total:
        mine = []
        for (of, w), a in some.items():
            if of != lang or (of, w) in lost:
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = count[lang, w[:k]], count[lang, w[k:]]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            mine.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


def docs_with_langs(spark, rows):
    langs = F.when(F.col("doc_id") % 4 == 1, "de").when(F.col("doc_id") % 4 == 2, "und").otherwise(F.col("lang"))
    return documents(spark, rows).withColumn("lang", langs)


def spoken_rows(seed, n=150):
    rng = random.Random(seed)
    words = [f"{w}{k}" for k in range(6) for w in ("a", "B", "ü", "x-")]
    rows = texts(seed)
    for k in range(n):
        out = []
        for _ in range(rng.randint(1, 60)):
            out.append(rng.choice(["New York City", "new york", "a0 b0 x-0 ü0 a1", "the", rng.choice(words), rng.choice(words)]))
        rows.append((5000 + k, "".join(w + rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "!", ";", " ", " "]) for w in out)))
    rows += [(9000, "nul\x00in word\x0bnew\x0cline " * 20), (9001, "a b " * 3000), (9002, "A B " * 50), (9003, ".,;:!?\n\r" * 5)]
    return rows


@pytest.mark.parametrize("least,top", [(20, 2000), (5, 7)])
def test_equals_counting_all(spark, monkeypatch, least, top):
    monkeypatch.setattr(collocations, "PART_BYTES", 3000)
    monkeypatch.setattr(collocations, "SHARD_PHRASES", 150)
    docs = docs_with_langs(spark, spoken_rows(6))
    want = brute([(r["text"], r["lang"]) for r in docs.collect()], least, top)
    assert as_set(collocations.collocations(docs, least=least, top=top), *RESULT) == want and len(want) > 20


def test_full_bitmap_loses_nothing(spark, monkeypatch):
    """A bitmap far too small lets phrases through that are then counted and dropped."""
    monkeypatch.setattr(collocations.Bitmap, "of", classmethod(lambda cls, keys, n: cls(20, np.full(1 << 17, 255, np.uint8))))
    docs = docs_with_langs(spark, spoken_rows(7, n=60))
    want = brute([(r["text"], r["lang"]) for r in docs.collect()], 12, 2000)
    assert as_set(collocations.collocations(docs, least=12), *RESULT) == want and want


def test_products_beyond_64_bits(spark):
    n = 3_000_000_000_000
    rows = spark.createDataFrame([(n // 7, n, n // 5, n // 6)], "a long, total long, l long, r long")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in rows.columns}
    got = rows.withColumn("over", F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["total"])).withColumn("under", wide["l"] * wide["r"])
    assert got.select(F.expr("over div under")).first()[0] == 1000 * (n // 7) * n // ((n // 5) * (n // 6))


def test_no_words_no_rows(spark):
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark, [(1, None), (2, ""), (3, " .\n")])).count() == 0
    assert collocations.collocations(documents(spark, [(1, "only once")])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_trie_counts_all_sequences(seed):
    rng = np.random.default_rng(seed)
    names = rng.integers(0, 2**63, 40, dtype=np.uint64)
    first = names[::3]  # two thirds of the symbols never come first
    sequences = {(int(rng.choice(first)), *rng.choice(names, rng.integers(0, 5)).tolist()) for _ in range(300)}
    sequences |= {(int(first[0]), int(x)) for x in names}
    listed = sorted(sequences)
    lengths = np.array([len(x) for x in listed])
    table = np.zeros((len(listed), 5), np.uint64)
    for row, sequence in zip(table, listed, strict=True):
        row[: len(sequence)] = sequence
    trie = DoubleArray.from_bytes(DoubleArray.build(table, lengths).to_bytes())
    text = rng.choice(np.append(names, np.uint64(5)), 4000)
    for k in rng.choice(3900, 300):
        some = listed[rng.integers(len(listed))]
        text[k : k + len(some)] = some
    group = np.cumsum(rng.random(4000) < 0.1)
    want = Counter(
        tuple(text[p : p + n].tolist()) for n in range(1, 6) for p in range(4001 - n) if group[p] == group[p + n - 1]
    )
    assert trie.counts(trie.symbols(text), group, 5).tolist() == [want[s] for s in listed]
    assert DoubleArray.build(np.zeros((0, 5), np.uint64), np.zeros(0, np.int64)).counts(np.zeros(3, np.int64) - 1, group, 5).tolist() == []


@pytest.mark.parametrize("step", [counted_words, summed((2,), Bitmap(20, np.full(1 << 17, 255, np.uint8)))], ids=["words", "pairs"])
def test_a_worker_holds_one_small_slice(step):
    """The arrays of a batch of 8 MB stay within 100 MB; two workers share an executor with the JVM."""
    rng = np.random.default_rng(3)
    words = np.array([f"word{k}" for k in range(3000)])
    texts = [" ".join(rng.choice(words, 1000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    tracemalloc.start()
    rows = sum(b.num_rows for b in step(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 3000 and peak < 100e6
