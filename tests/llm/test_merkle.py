"""The manifest against a tree built row by row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import merkle

RESULT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and for each leaf the digests left and right of its path."""
    paths, below = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, gathered = [], []
        for lo in range(0, len(nodes), 8):
            run = nodes[lo : lo + 8]
            for k in range(len(run)):
                for node in below[lo + k]:
                    paths[node].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(digest("".join(run)))
            gathered.append([x for part in below[lo : lo + 8] for x in part])
        nodes, below = up, gathered
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    parts, tops = [], []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        mine = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        top, paths = tree([leaf(r, r["text"]) for r in mine])
        parts.append((mine, paths))
        tops.append(top)
    root, crown = tree(tops) if tops else (None, [])
    out = []
    for (mine, paths), top, beyond in zip(parts, tops, crown, strict=True):
        for row, path in zip(mine, paths, strict=True):
            first = leaf(row, row["text"])
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            x = leaf(row, lowered(row["text"])) if hit else first
            for left, right in path + beyond:
                x = digest(left + x + right)
            proof = digest("".join(left + right for left, right in path + beyond))
            out.append((row["doc_id"], first, top, root, proof, x, x == root))
    return sorted(out, key=repr)


def of(docs):
    return as_set(merkle.report(docs), *RESULT), brute([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_equals_tree_of_all_rows(spark, monkeypatch, digits):
    """Blocks of 8, 64 and 4096 leaves, so several rounds, one and none."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 8**digits)
    monkeypatch.setattr(merkle, "PART_ROWS", 20)
    docs = documents(spark, texts(3, n=80))
    langs = F.when(F.col("doc_id") % 11 == 1, "").when(F.col("doc_id") % 13 == 2, "Ärger").otherwise(F.col("lang"))
    got, want = of(docs.withColumn("lang", langs))
    assert got == want
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65])
def test_sizes_around_full_runs(spark, n):
    docs = documents(spark, [(5 * k, f"Text {k}") for k in range(n)]).withColumn("lang", F.lit("en"))
    got, want = of(docs)
    assert got == want


def test_empty_table(spark):
    assert merkle.report(documents(spark, [])).count() == 0


def test_many_groups(spark):
    docs = documents(spark, [(k, "A") for k in range(150)]).withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 70).cast("string")))
    got, want = of(docs)
    assert got == want


def test_floods_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_ROWS", 16)
    docs = documents(spark, [(7, "Same"), (3, "b")]).select("doc_id", "text", F.lit("x").alias("lang"), "source", F.lit(1).alias("n_chars"))
    docs = docs.unionByName(docs.filter("doc_id = 7").crossJoin(spark.range(99).select(F.lit(0).alias("z"))).drop("z"))
    got, want = of(docs)
    assert got == want


def test_changed_rows_are_found(spark):
    docs = documents(spark, texts(5)).filter("doc_id is not null").dropDuplicates(["doc_id"])
    proofs = merkle.manifest(docs)
    assert not merkle.verified(proofs, docs).filter("not verified").count()
    changed = docs.withColumn("n_chars", F.when(F.col("doc_id") == 9, -1).otherwise(F.col("n_chars")))
    assert [r["id"] for r in merkle.verified(proofs, changed).filter("not verified").collect()] == [9]
    alien = docs.limit(1).withColumn("doc_id", F.lit(-99).cast("long"))
    assert [r["verified"] for r in merkle.verified(proofs, alien).collect()] == [False]
