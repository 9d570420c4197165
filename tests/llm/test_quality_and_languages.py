"""Weak supervision and language identification: counts against brute force, decisions against labels."""

import math
import re
from itertools import product

import duckdb
import numpy as np
import pytest

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import language_id, weak_supervision

SF = "/root/testdata/sf0.1"


def counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for k in range(len(words) - 4):
        seen.setdefault(tuple(words[k : k + 5]), []).append(k)
    twice = {k + j for places in seen.values() if len(places) > 1 for k in places for j in range(5)}
    failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice), failed,
    )


def test_counts_equal_brute_force(spark):
    rows = texts(3) + [(900, "a b\na b\n \n\na b"), (901, "x y z x y z x y z x y z x y"), (902, "##|| <b> & 5%"), (903, "\n")]
    got = weak_supervision.judged(documents(spark, rows))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert as_set(got, *base) == sorted(((i, *counts(t)) for i, t in rows), key=repr)
    assert got.filter("kept and base_failed").isEmpty()


def test_estimation_finds_planted_accuracies():
    """Five rules that vote on half of a balanced corpus, independently, with known accuracies."""
    right = (0.95, 0.9, 0.6, 0.8, 0.7)
    patterns = {}
    for votes in product((-1, 0, 1), repeat=5):
        side = [math.prod(0.5 if v == 0 else 0.5 * (p if v == y else 1 - p) for v, p in zip(votes, right, strict=True)) for y in (1, -1)]
        patterns[votes] = round(10_000_000 * sum(side) / 2)
    found = weak_supervision.estimate(patterns, 5, rounds=5000, tolerance=1e-12)
    start, share = weak_supervision.ACCURACY, weak_supervision.PSEUDO_SHARE
    assert sorted(range(5), key=found.__getitem__) == sorted(range(5), key=right.__getitem__)
    assert found == pytest.approx([(r + share * start) / (1 + share) for r in right], abs=0.03)
    alone = weak_supervision.estimate({(0, -1): 1000, (1, 0): 5000}, 2)
    assert alone == pytest.approx([weak_supervision.ACCURACY] * 2, abs=1e-6)


def test_no_documents(spark):
    assert weak_supervision.report(documents(spark, [])).count() == 0
    assert language_id.report(documents(spark, [])).count() == 0
    assert weak_supervision.estimate({}, 2) == [weak_supervision.ACCURACY] * 2


def test_posterior_agrees_with_labels(spark):
    judged = weak_supervision.report(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "kept", "base_failed").toArrow()
    rows = duckdb.sql(
        f"SELECT kept, l.quality, count(*) n FROM judged JOIN '{SF}/labels.parquet' l USING (doc_id) WHERE NOT base_failed GROUP BY ALL"
    ).fetchall()
    table = {(k, q): n for k, q, n in rows}
    kept_good = table[True, 1] / (table[True, 1] + table.get((False, 1), 0))
    dropped_bad = table.get((False, 0), 0) / (table.get((False, 0), 0) + table.get((True, 0), 0))
    assert kept_good > 0.98 and dropped_bad > 0.95


def test_forward_sum_equals_all_segmentations():
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"ba", b" ab", b"c"]
    rng = np.random.default_rng(2)
    chance = rng.random((len(pieces), 2))
    index = {p: k for k, p in enumerate(pieces)}

    def brute(word):
        if not word:
            return np.ones(2)
        return sum((chance[index[word[:n]]] * brute(word[n:]) for n in range(1, min(3, len(word)) + 1) if word[:n] in index), np.zeros(2))

    words = [b" ab", b" abba", b" cab", b" " + b"ab" * 7, b" a"]
    lattice = language_id.Lattice(language_id.as_slice(words), language_id.Pieces(pieces))
    sums = lattice.forward(chance)
    size = lattice.size[lattice.order]
    got = np.empty((len(words), 2))
    got[lattice.order] = sums[size, np.arange(len(words))]
    assert got == pytest.approx(np.array([brute(w) for w in words]))
    # expected counts: pieces times their lengths cover every byte once
    counts = lattice.expected(chance, np.ones((len(words), 2)))
    covered = (counts * np.array([len(p) for p in pieces])[:, None]).sum(axis=0)
    assert covered == pytest.approx([sum(map(len, words))] * 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.report(docs).toArrow()
    right = duckdb.sql(
        f"SELECT avg(CAST(lang_pred = lang AS INT)), count(*) FROM found JOIN '{SF}/documents.parquet' USING (doc_id) "
        "WHERE held_out AND regexp_matches(text, '\\p{L}')"
    ).fetchall()[0]
    assert right[0] > 0.99 and right[1] > 1500
    assert duckdb.sql("SELECT min(score) >= 0 AND max(score) <= 1 FROM found").fetchall()[0][0]


def test_hard_rows_have_a_language(spark):
    rows = [(k, "el perro come la casa grande donde vive") for k in range(30)]
    rows += [(100 + k, "the dog eats in the big house where it lives") for k in range(30)]
    lang = {**{k: "es" for k in range(30)}, **{100 + k: "en" for k in range(30)}}
    odd = [(None, "the house"), (200, None), (201, ""), (202, "123 456 !!"), (203, "x" * 200_000), (204, "la casa " * 9000), (205, "ß")]
    docs = spark.createDataFrame([(i, t, lang.get(i)) for i, t in rows + odd + odd], "doc_id long, text string, lang string")
    got = language_id.report(docs).collect()
    assert len(got) == 74
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (200, 201, 202))
    assert by[204]["lang_pred"] == "es" and by[0]["lang_pred"] == "es" and by[100]["lang_pred"] == "en"
    assert by[None]["held_out"] and by[None]["lang_pred"] == "en" and by[203]["lang_pred"] in ("en", "es")
    kept = language_id.identified(docs)
    assert kept.columns == docs.columns and kept.filter("text is null").isEmpty()


def test_without_labels_all_is_unknown(spark):
    docs = spark.createDataFrame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.report(docs).collect()] == ["und"]


def test_scripts_without_spaces_long_documents_and_rare_labels_are_learned(spark):
    rng = np.random.default_rng(3)
    alphabets = {"zh": "的一是不了人我在有他这中大来上", "ja": "のにはをたがでてとしれさあいう", "th": "กขคงจชซดตถทนบปผ"}
    run = lambda lang: "".join(rng.choice(list(alphabets[lang]), 60))
    rows = [(k * 40 + i, run(lang), lang) for k, lang in enumerate(alphabets) for i in range(40)]
    rows += [(1000 + i, "el perro come la casa grande donde vive " * 500, "es") for i in range(12)]
    rows += [(2000 + i, "the dog eats in the big house where it lives", "en") for i in range(12)]
    rows += [(3000 + i, f"word{i % 110}", f"x{i % 110:03}") for i in range(1100)]
    docs = spark.createDataFrame([*rows, (5000, None, "no")], "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.languages == sorted({lang for _, _, lang in rows})
    asked = spark.createDataFrame(
        [(lang, run(lang)) for lang in alphabets for _ in range(20)] + [("es", "la casa donde vive el perro")], "doc_id string, text string"
    )
    got = language_id.predict(asked, model).select("doc_id", "language.lang_pred").collect()
    assert len(got) == 61 and all(r["doc_id"] == r["lang_pred"] for r in got)
