"""Near-duplicate groups against all pairs of sets."""

import random

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import near_dedup
from wakeline.llm.components import components


def shingles(text):
    words = [w for w in (text or "").translate({k: k + 32 for k in range(65, 91)}).encode().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    top = {i: i for i, _ in sets if i is not None}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    known = [(i, s) for i, s in dict.fromkeys(sets) if i is not None and s]
    for k, (i, s) in enumerate(known):
        for j, t in known[:k]:
            common = len(s & t)
            if 100 * common >= 75 * (len(s) + len(t) - common):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr)


def variants(rng, base, n, first, edits):
    """Copies of a text with some words exchanged."""
    for k in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        yield first + k, " ".join(words)


def test_equals_all_pairs(spark):
    rng = random.Random(8)
    rows = texts(2)
    base = " ".join(f"b{rng.randrange(5000)}" for _ in range(300))
    rows += variants(rng, base, 25, 1000, 3)
    rows += variants(rng, base, 25, 2000, 9)
    rows += [(900, base.upper()), (901, base.replace(" ", "\n\t")), (3000, "Two Words"), (3001, "two  words"), (3002, "two")]
    got = near_dedup.near_duplicates(documents(spark, rows))
    assert as_set(got, "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_large_group_and_hub(spark, monkeypatch):
    """More copies than a key is walked in full; copies of copies that only a hub in the middle ties together."""
    rng = random.Random(9)
    monkeypatch.setattr(near_dedup, "TASK_SHINGLES", 3000)
    base = " ".join(f"b{rng.randrange(5000)}" for _ in range(200))
    rows = [(5000, base), *variants(rng, base, 120, 100, 1), *variants(rng, base, 60, 6000, 5), *variants(rng, base, 60, 7000, 11)]
    got = near_dedup.near_duplicates(documents(spark, rows))
    assert as_set(got, "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_one_of_each_keeps_columns_and_clean_rows(spark):
    rows = texts(4)
    docs = documents(spark, rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.schema == docs.schema
    want = {(i, t) for (i, t), (_, _, _, k) in zip(sorted(rows, key=repr), [r for r in brute(sorted(rows, key=repr))], strict=True) if k}
    keep_ids = {r[0] for r in brute(rows) if r[3]}
    got = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert {i for i, _ in got} == keep_ids and want
    assert len([i for i, _ in got if i is not None]) == len({i for i, _ in got if i is not None})


def test_empty_table(spark):
    empty = documents(spark, [])
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.one_of_each(empty).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[101] == 100
