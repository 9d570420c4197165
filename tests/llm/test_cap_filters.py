"""Linked vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from tests.llm.cases import as_set
from wakeline.llm import cap_filters

SCHEMA = "vec_id long, embedding array<double>, label int, n int, dims string, place long, cid int"
RESULT = ("vec_id", "n_links", "component_id", "kept")


def table(spark, rows, kind="double", parts=3):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], label, k, "d", k, k) for k, (i, v, label) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA.replace("array<double>", f"array<{kind}>")).repartition(parts)


def usable(vector, label):
    return label is not None and bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute(rows, threshold=0.93):
    top = {i: i for i, _, _ in rows if i is not None}
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def tie(x, y):
        parent[root(x)] = root(y)

    links = [0] * len(rows)
    arrays = [np.array(v, float) / max(map(abs, v)) if usable(v, label) else None for _, v, label in rows]
    for k, (i, _, label) in enumerate(rows):
        for j in range(k):
            x, y = arrays[k], arrays[j]
            if x is None or y is None:
                continue
            if i is not None and i == rows[j][0]:
                tie(k, j)
            if label == rows[j][2] and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                links[k] += 1
                links[j] += 1
                tie(k, j)
    lowest = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            lowest[root(k)] = min(i, lowest.get(root(k), i))
    out = []
    for k, (i, _, _) in enumerate(rows):
        low = i if arrays[k] is None else lowest.get(root(k))
        out.append((i, links[k], low, i is None or low is None or i == low))
    return sorted(out, key=repr)


def turned(rng, x, cosine):
    """A vector at that cosine to ``x``."""
    y = rng.standard_normal(len(x))
    y -= y @ x / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine * cosine) * y / np.linalg.norm(y)


def hard(seed, dims=24):
    rng = np.random.default_rng(seed)
    rows = [(k * 7, rng.standard_normal(dims), k % 3) for k in range(120)]
    for k in range(60):
        base = rows[rng.integers(len(rows))]
        rows.append((1000 + k, turned(rng, np.array(base[1]), rng.choice([0.99, 0.96, 0.945, 0.92])), base[2]))
    copy = rows[5]
    rows += [(2000 + k, copy[1], copy[2]) for k in range(12)] + [(2100, copy[1], (copy[2] + 1) % 3), (2101, 3 * np.array(copy[1]), copy[2])]
    rows += [
        (None, copy[1], copy[2]), (None, None, 1), (None, [9.0] * 5, 1), (None, [9.0] * 5, 1), (3000, None, 1), (3001, [], 1), (3002, [0.0] * dims, 1),
        (3003, [math.nan] + [1.0] * (dims - 1), 1), (3004, [math.inf] * dims, 1), (3005, [None] + [1.0] * (dims - 1), 1), (3006, copy[1], None),
        (3007, [1.0, 2.0], 1), (3008, [1.0, 2.0], 1), (3009, [1.0, 2.01], 1), (3010, [1e200] * dims, 0), (3011, [1e-200] * dims, 0),
        (3012, [2.0], 2), (3013, [5.0], 2), (3014, [-5.0], 2), copy, (copy[0], rows[40][1], copy[2]), (-8, rows[130][1], rows[130][2]),
    ]
    return [(i, None if v is None else list(v), label) for i, v, label in rows]


@pytest.mark.parametrize("kind", ["double", "float"])
def test_equals_all_pairs(spark, kind):
    rows = hard(1)
    if kind == "float":
        rows = [r for r in rows if not r[1] or r[0] not in (3010, 3011)]
        rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert as_set(cap_filters.near_vectors(table(spark, rows, kind)), *RESULT) == brute(rows)


def test_crowds_and_stars(spark, monkeypatch):
    """Parts of crowded places; vectors that are all linked, and vectors that only one in the middle ties together."""
    monkeypatch.setattr(cap_filters, "PLACE_ROWS", 30)
    monkeypatch.setattr(cap_filters, "BUCKET_ROWS", 500)
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(32), 1) for k in range(100)]
    rows += [(500 + k, turned(rng, rows[1][1], 0.99), 1) for k in range(90)]
    rows += [(700 + k, turned(rng, rows[2][1], 0.94), 1) for k in range(60)]
    rows = [(i, list(v), label) for i, v, label in rows]
    assert as_set(cap_filters.near_vectors(table(spark, rows)), *RESULT) == brute(rows)


def test_recall_at_the_threshold():
    """Pairs hardly above the threshold, with codes of several sizes: the share without a place in common."""
    for classes in (1000, 60_000):
        code = cap_filters.code_for(64, classes)
        rng = np.random.default_rng(9)
        x = rng.standard_normal((4000, 64))
        y = np.array([turned(rng, v, 0.9301) for v in x])
        met = np.zeros(len(x), bool)
        for k in range(code.codes):
            a, b = (set(zip(*(v.tolist() for v in cap_filters.decoded(cap_filters.rounded(q), code, k)), strict=True)) for q in (x, y))
            met[[row for row, _ in a & b]] = True
        assert (~met).sum() <= 1


def test_decoding_finds_all_filters():
    """Every direction of the product code with both halves together, one by one."""
    code = cap_filters.code_for(10, 50)
    q = cap_filters.rounded(np.random.default_rng(2).standard_normal((40, 10)))
    for ranges in (1, 7):
        some = cap_filters.Code(10, code.size, ranges, code.cap, 1, 0.93)
        one, two = cap_filters.halves(10, code.size, 0)
        width = math.ceil(code.size / ranges)
        want = sorted({
            (r, i * ranges + j // width) for r in range(40) for i in range(code.size) for j in range(code.size)
            if q[r] @ (one[:, i] + two[:, j]) >= code.cap
        })
        row, place = cap_filters.decoded(q, some, 0)
        assert list(zip(row.tolist(), place.tolist(), strict=True)) == want and want


def test_same_filters_in_any_batch():
    code = cap_filters.code_for(64, 5000)
    x = np.random.default_rng(3).standard_normal((50, 64))
    row, place = cap_filters.decoded(cap_filters.rounded(x), code, 1)
    for k in random.Random(1).sample(range(50), 10):
        assert cap_filters.decoded(cap_filters.rounded(x[k : k + 1]), code, 1)[1].tolist() == place[row == k].tolist()


def test_empty_table(spark):
    assert cap_filters.near_vectors(table(spark, [])).count() == 0
