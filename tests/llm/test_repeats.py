"""Both removals of repeated passages against a plain count of all windows."""

import hashlib
import random

import pytest

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import suffix_intervals, suffix_trees

ROWS = texts()


def removed(rows, symbols, size):
    """Which symbols a window covers that also starts in a document with a smaller id."""
    lowest = {}
    for i, t in rows:
        s = symbols(t)
        for k in range(len(s) - size + 1) if i is not None else ():
            w = s[k : k + size] if isinstance(s, bytes) else tuple(s[k : k + size])
            lowest[w] = min(i, lowest.get(w, i))
    for i, t in rows:
        s = symbols(t)
        gone = [False] * len(s)
        for k in range(len(s) - size + 1) if i is not None else ():
            w = s[k : k + size] if isinstance(s, bytes) else tuple(s[k : k + size])
            if lowest[w] < i:
                gone[k : k + size] = [True] * size
        yield i, s, gone


def spans(gone):
    return sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))


@pytest.mark.parametrize("sizes", [{}, {"group_items": 400, "batch_bytes": 3000}])
def test_words_equal_brute_force(spark, sizes):
    want = sorted((
        (i, len(s), sum(g), spans(g), hashlib.sha256(b" ".join(w for w, x in zip(s, g, strict=True) if not x)).hexdigest())
        for i, s, g in removed(ROWS, lambda t: (t or "").encode().split(), suffix_trees.SIZE)
    ), key=repr)
    got = suffix_trees.repeats(documents(spark, ROWS), **sizes).selectExpr(
        "doc_id", "n_words", "n_removed", "size(starts) n_spans", "kept_sha256")
    assert as_set(got, *got.columns) == want
    assert sum(x[2] for x in want) > 300


@pytest.mark.parametrize("sizes", [{}, {"anchor_bytes": 9000, "segment_bytes": 5000, "batch_bytes": 7000}])
def test_bytes_equal_brute_force(spark, sizes):
    want = sorted((
        (i, len(s), sum(g), spans(g), hashlib.sha256(bytes(c for c, x in zip(s, g, strict=True) if not x)).hexdigest())
        for i, s, g in removed(ROWS, lambda t: (t or "").encode(), suffix_intervals.SIZE)
    ), key=repr)
    got = suffix_intervals.repeats(documents(spark, ROWS), **sizes).selectExpr(
        "doc_id", "n_bytes", "n_removed", "size(starts) n_spans", "kept_sha256")
    assert as_set(got, *got.columns) == want
    assert sum(x[2] for x in want) > 1000


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert suffix_trees.report(empty).count() == 0
    assert suffix_intervals.report(empty).count() == 0
    nothing = documents(spark, [(1, None), (None, ""), (2, "")])
    assert {r["n_words"] for r in suffix_trees.report(nothing).collect()} == {0}
    assert {r["n_removed"] for r in suffix_intervals.report(nothing).collect()} == {0}


def test_kept_text_and_spans(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    got = {r["doc_id"]: r for r in suffix_trees.repeats(
        documents(spark, [(1, f"a b {passage}"), (2, f"c  {passage}\nd")]), with_text=True).collect()}
    assert got[2]["kept_text"] == "c d" and (got[2]["starts"], got[2]["ends"]) == ([1], [21])
    assert got[1]["kept_text"] == f"a b {passage}"
    got = {r["doc_id"]: r for r in suffix_intervals.repeats(
        documents(spark, [(1, f"a b {passage}"), (2, f"c  {passage}\nd")]), with_bytes=True).collect()}
    assert bytes(got[2]["kept"]) == b"c \nd"


def test_maximal_repeats_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choices("abc", k=60))) for k in range(6)]
    shared = "".join(rng.choices("abcdefgh", k=70))
    rows += [(10, "x" + shared + "y"), (11, "z" + shared + "w"), (12, "x" + shared[:60] + "q"), (13, shared), (14, None), (None, shared)]
    known = [(i, t) for i, t in rows if i is not None and t]
    want = set()
    size = 20
    for a, s in known:
        for k in range(len(s) - size + 1):
            for n in range(size, len(s) - k + 1):
                w = s[k : k + n]
                places = [(i, p) for i, t in known for p in range(len(t) - n + 1) if t.startswith(w, p)]
                if len({i for i, _ in places}) < 2:
                    break
                text = dict(known)
                left = {text[i][p - 1] if p else (i, "start") for i, p in places}
                right = {text[i][p + n] if p + n < len(text[i]) else (i, "end") for i, p in places}
                if len(left) > 1 and len(right) > 1:
                    want.add((w.encode(), tuple(sorted(places))))
    got = {}
    for r in suffix_intervals.maximal_repeats(documents(spark, rows), size=size, gram=8).collect():
        got.setdefault(bytes(r["repeat"]), []).append((r["doc_id"], r["start"]))
    assert {(w, tuple(sorted(p))) for w, p in got.items()} == want
    assert want
