"""Token counts from flat files, and optimal buckets, against plain computations."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import length_buckets, separator_scan

ROWS = texts(7) + [(950, "<|endoftext|> is ordinary text"), (951, "💚" * 300)]


def test_token_counts(spark):
    encode = separator_scan.encoder(separator_scan.vocabulary()).encode_ordinary
    got = separator_scan.token_counts(documents(spark, ROWS))
    assert as_set(got, "doc_id", "n_tokens") == sorted(((i, len(encode(t or ""))) for i, t in ROWS), key=repr)


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_stitching_blocks(spark, monkeypatch, block):
    """Documents of all lengths over blocks of all sizes, more blocks than a span has, and a file with an open end."""
    monkeypatch.setattr(separator_scan, "SPAN", 5)
    rng = random.Random(block)
    rows, want = [], []
    for file in range(3):
        lengths = [rng.choice([0, 0, 1, 3, 30, 90]) for _ in range(25)]
        tokens = [x for n in lengths for x in [7] * n + [separator_scan.END]] + [9] * (4 * file)
        flat = np.array(tokens, np.uint16)
        rows += [(file, k, bytearray(flat[k * block : (k + 1) * block].tobytes())) for k in range(-(-len(flat) // block))]
        want += [(file, k, n, True) for k, n in enumerate(lengths)] + ([(file, 25, 4 * file, False)] if file else [])
    blocks = spark.createDataFrame(rows, "file long, block long, tokens binary").repartition(4)
    assert as_set(separator_scan.documents_in(blocks), "file", "ordinal", "n_tokens", "closed") == sorted(want, key=repr)


def test_no_files(spark):
    none = spark.createDataFrame([], "file long, block long, tokens binary")
    assert separator_scan.documents_in(none).count() == 0
    assert separator_scan.token_counts(documents(spark, [])).count() == 0


def padding(histogram, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram.items())


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 30) for n in rng.sample(range(1, 60), 9)}
    for buckets in (1, 2, 4, 20):
        bounds = length_buckets.boundaries(histogram, buckets)
        k = min(buckets, len(histogram))
        best = min(padding(histogram, (*c, max(histogram))) for c in combinations(sorted(histogram), k - 1))
        assert len(bounds) <= buckets and padding(histogram, bounds) == best
    assert length_buckets.boundaries({}, 4) == []


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(length_buckets, "CELL", 3)
    docs = documents(spark, ROWS)
    got = length_buckets.pack(docs, max_length=500, buckets=5, token_budget=2000).collect()
    want = []
    for i, t in ROWS:
        n = len((t or "").encode())
        want += [(i, k, k * 500, min(500, n - k * 500)) for k in range(-(-n // 500))]
    assert sorted(((r["doc_id"], r["piece"], r["first_token"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    histogram = {}
    for *_, n in want:
        histogram[n] = histogram.get(n, 0) + 1
    bounds = length_buckets.boundaries(histogram, 5)
    groups = {}
    for r in got:
        assert r["padded_length"] == min(b for b in bounds if b >= r["n_tokens"]) == bounds[r["bucket"]]
        groups.setdefault((r["bucket"], r["batch"]), []).append(r["place"])
    for (bucket, batch), places in groups.items():
        most = 2000 // bounds[bucket]
        last = max(b for k, b in groups if k == bucket)
        assert sorted(places) == list(range(len(places))) and len(places) <= most
        assert batch == last or len(places) == most


def test_own_token_count_and_no_rows(spark):
    docs = documents(spark, [(1, "a b c"), (2, None)])
    words = F.when(F.col("text").isNotNull(), F.size(F.split("text", " ")))
    assert as_set(length_buckets.pack(docs, words), "doc_id", "n_tokens") == [(1, 3)]
    assert length_buckets.pack(documents(spark, [])).count() == 0
    assert length_buckets.pack(documents(spark, [(1, ""), (2, None)])).count() == 0
    with pytest.raises(ValueError):
        length_buckets.pack(docs, max_length=100, token_budget=50)
