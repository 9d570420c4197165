"""Decontamination against a search for every window."""

import hashlib
import random
import re

import pytest

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import winnowing

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text):
    return WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}).encode())


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n and i is not None else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    lengths = {len(w) for w in windows}
    for i, t in rows:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[k : k + n])):
                    hit[k : k + n] = [True] * n
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield i, len(w), sum(hit), len(found), sha, bool(found)


def benchmark(rows):
    rng = random.Random(5)
    items = []
    for k in range(12):
        source = [w.decode() for w in words(rows[4 * k][1])]
        at = rng.randrange(max(1, len(source) - 14))
        items.append((k, ", ".join(source[at : at + 14]).upper()))
    return [*items, (20, "one"), (21, " ".join(rows[9][1].split()[:4])), (22, ""), (23, None), (None, rows[1][1]), (20, "same same same"),
            (24, "nowhere to be found in any of the texts at all, whatever comes")]


@pytest.mark.parametrize("block", [winnowing.BLOCK_BYTES, 150])
def test_equals_brute_force(spark, block):
    rows = texts(6)
    items = benchmark(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    want = sorted(brute(rows, items), key=repr)
    if block == winnowing.BLOCK_BYTES:
        got = winnowing.report(docs, bench)
        assert as_set(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    got = winnowing.annotate(docs, bench, block_bytes=block).selectExpr(
        "doc_id", "contamination.n_words", "cast(aggregate(zip_with(contamination.ends, contamination.starts, (a, b) -> a - b), 0, "
        "(a, b) -> a + b) as long) n_hit", "cast(size(contamination.items) as long) n_items")
    assert as_set(got, *got.columns) == sorted((w[:4] for w in want), key=repr)
    kept = winnowing.without_contaminated(docs, bench)
    assert kept.schema == docs.schema
    assert as_set(kept, "doc_id") == sorted(((w[0],) for w in want if not w[5]), key=repr)


def test_a_joined_benchmark_gives_what_a_held_one_gives(spark):
    """Copies, nulls, columns with clashing names, and a window that many items and documents have."""
    rows = texts(6)
    shared = "these ten words stand in nearly all of the items given"
    rows = [(i, f"{t} {shared} end {i % 3}" if t and i and i % 2 else t) for i, t in rows] + [rows[3], (None, rows[5][1]), (901, None), (902, "")]
    items = benchmark(rows) + [(k, f"{k} {shared} {k} {k}") for k in range(100, 160)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows).selectExpr("*", "1 AS key", "'x' AS text_key", "2 AS Hit", "3 AS word_count", "4 AS item", "5 AS starts")
    held = winnowing.annotate(docs, bench)
    joined = winnowing.annotate(docs, bench, block_bytes=1000)
    assert joined.columns == held.columns
    flat = [c for c in docs.columns] + [f"contamination.{c}" for c in ("n_words", "starts", "ends", "items")]
    one, two = (sorted(map(repr, df.select(*flat).collect())) for df in (held, joined))
    assert one == two and any("'100'" in r for r in one)
    only = winnowing.annotate(docs, bench, keep=["doc_id"], block_bytes=1000)
    assert only.columns == ["doc_id", "contamination"] and only.count() == len(rows)


def test_a_joined_benchmark_without_words(spark):
    bench = spark.createDataFrame([(1, "... --- ...")], "item_id long, text string")
    got = winnowing.annotate(documents(spark, texts(6)), bench, block_bytes=1)
    assert got.filter("size(contamination.starts) > 0").count() == 0 and got.count() == len(texts(6))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, texts(6))
    assert winnowing.report(docs, none).filter("contaminated").count() == 0
    assert winnowing.without_contaminated(docs, none).count() == docs.count()
    assert winnowing.report(documents(spark, []), none).count() == 0


def test_name_clash_is_refused(spark):
    docs = documents(spark, [(1, "a")])
    with pytest.raises(ValueError):
        winnowing.annotate(docs, docs.select("doc_id", "text"), result="BATCH")
