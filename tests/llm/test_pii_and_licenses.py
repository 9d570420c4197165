"""Pseudonyms against an independent computation and their inverse; licence digests on variants of known texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import as_set, documents, texts
from wakeline.llm import license_digest, pii
from wakeline.llm.license_texts import KNOWN

KEY = "k1"


def digest(kind, turn, text):
    seed = f"{KEY}|{kind}|{turn}|{text}"
    return "".join(hashlib.sha256(f"{n}|{seed}|{KEY}".encode()).hexdigest() for n in (0, 1))


def shift(char, by):
    for first, n in (("0", 10), ("a", 26), ("A", 26)):
        if first <= char < chr(ord(first) + n):
            return chr((ord(char) - ord(first) + by) % n + ord(first))
    return char


def permute(kind, text, sign=1):
    """The Feistel network in plain Python; ``sign`` -1 runs it backwards."""
    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for i in range(1, 9) if sign > 0 else range(8, 0, -1):
        if i % 2:
            h = digest(kind, i, right)
            left = "".join(shift(c, sign * int(h[4 * j : 4 * j + 4], 16)) for j, c in enumerate(left))
        else:
            h = digest(kind, i, left)
            right = "".join(shift(c, sign * int(h[4 * j : 4 * j + 4], 16)) for j, c in enumerate(right))
    return left + right


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def with_check(body):
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def changed(spark, rows):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "doc_id long, text string")
    return [r["text"] for r in pii.report(df, KEY).orderBy("doc_id").collect()]


def test_cards_and_mail_round_trip(spark):
    rng = random.Random(1)
    cards = [with_check("".join(rng.choices("0123456789", k=15))) for _ in range(40)]
    mails = [f"{''.join(rng.choices('abcXYZé', k=6))}.{k}@mail.example.com" for k in range(40)]
    got = changed(spark, [f"a {c} b {m} c" for c, m in zip(cards, mails, strict=True)])
    for c, m, t in zip(cards, mails, got, strict=True):
        _, card, _, mail, _ = t.split(" ")
        assert luhn(card) and card != c and card[0] == c[0]
        assert permute("card", card[1:-1], -1) == c[1:-1]
        assert permute("email", mail.split("@")[0], -1) + "@mail.example.com" == m
    assert len(set(got)) == len(got)


@pytest.mark.parametrize("sizes", [(5, 7), (27, 54), (80_000, 3)])
def test_pairs_are_permuted(spark, sizes):
    n = min(3000, sizes[0] * sizes[1])
    df = spark.range(n).select((F.col("id") % sizes[0]).alias("l"), F.floor(F.col("id") / sizes[0]).alias("r"))
    pair = pii.permute_pair(F.lit(KEY), "x", F.col("l"), F.col("r"), sizes)
    got = df.select(pair.alias("p")).select("p.left", "p.right")
    assert got.distinct().count() == n
    assert got.filter(f"left < 0 or left >= {sizes[0]} or right < 0 or right >= {sizes[1]}").isEmpty()


def test_only_valid_values_change(spark):
    same = [
        "4111111111111112", "300.1.1.1", "10.01.2.3", "1.2.3", "000-12-3456", "666-12-3456", "2021-02-30", "31.13.1999", "DE00370400440532013000",
        "version 4.0", "9.9.", "token = \"xyz\"", "a@b", "12345", "+1", None, "", " ",
    ]
    assert changed(spark, same) == same
    rows = ["+1 (523) 555-1055", "+1-523-555-1055", "192.168.1.77", "123-45-6789", "2021-02-28", "28.02.2021", "DE89370400440532013000",
            "GB82 WEST 1234 5698 7654 32", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", "TOKEN = \"9AB9A9ECF9C9B99FE9999999B9B99BC9\"",
            "+44 20 7946 0958"]
    got = changed(spark, rows)
    assert all(a != b for a, b in zip(rows, got, strict=True))
    shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", t)))
    assert [shape(t) for t in got[:8]] == [shape(t) for t in rows[:8]]
    assert max(map(int, got[2].split("."))) < 256
    assert re.sub(r"\D", "", got[0]) == re.sub(r"\D", "", got[1])
    assert got[4].split("-") == got[5].split(".")[::-1]
    assert changed(spark, got[6:8]) != got[6:8]  # check digits are right again, so they are found again
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[8]) and re.fullmatch(r'TOKEN = "[0-9A-F]{32}"', got[9])


def test_equal_values_stay_linked_and_text_around_stays(spark):
    rows = [(1, "x 4111 1111 1111 1111, y"), (2, "4111111111111111"), (2, "4111111111111111"), (None, "ß4111-1111-1111-1111é"), *texts(5)]
    docs = documents(spark, rows)
    got = pii.pseudonymised(docs, KEY)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert as_set(got.drop("text"), *[c for c in docs.columns if c != "text"]) == as_set(docs, *[c for c in docs.columns if c != "text"])
    cards = {re.sub(r"\D", "", r["text"]) for r in got.filter("text like '%4___%' and length(text) < 30").collect()}
    assert len(cards) == 1
    plain = documents(spark, texts(5))
    assert as_set(pii.pseudonymised(plain, KEY), "doc_id", "text") == as_set(plain, "doc_id", "text")
    assert pii.report(documents(spark, []), KEY).count() == 0


def test_long_text(spark):
    text = ("word " * 50_000) + "4111111111111111 " + "x" * 100_000 + " 1" * 1000
    assert len(changed(spark, [text])[0]) == len(text)


def test_cards_next_to_other_digits(spark):
    cases = [
        ("", "4111 1111 1111 1111", " 12/25"), ("", "4111111111111111", " 123"), ("7 ", "4111 1111 1111 1111", ""),
        ("1234 5678 ", "4111-1111-1111-1111", " 192.168.1.300"), ("no. 12 ", "3782 822463 10005", " 4444 22 1"),
        ("", "4111 1111 1111 1111", " 5x"), ("12345678901234567890 ", "5500000000000004", " 99999999999999999999"),
        ("8 ", with_check("912345678901234"), " 1"),
    ]
    rows = changed(spark, ["".join(case) for case in cases])
    for (front, number, behind), got in zip(cases, rows, strict=True):
        plain = re.sub(r"\D", "", number)
        assert got.startswith(front) and got.endswith(behind)
        middle = got[len(front) : len(got) - len(behind)]
        assert re.sub(r"\d", "9", middle) == re.sub(r"\d", "9", number)
        assert re.sub(r"\D", "", middle) == with_check(plain[0] + permute("card", plain[1:-1]))


def test_all_values_of_a_run_of_digits(spark):
    number = "4111 1111 1111 1111"
    (one,) = changed(spark, [number])
    same = ["4112 1111 1111 1111 12", "12 5 77 31 8 90 4 2 61 77 10 33 25 1"]
    assert changed(spark, same) == same
    rest = ["2021-02-28", "123-45-6789", "28.02.2021", "192.168.1.77", "5a@b.example.com", "+1 523 555 1055"]
    alone = changed(spark, rest)
    got = changed(spark, [f"{number} {x}" for x in rest] + [f"{number} 5500 0000 0000 0004 {number}"])
    assert got[:-1] == [f"{one} {x}" for x in alone]
    assert got[-1] == f"{one} {changed(spark, ['5500 0000 0000 0004'])[0]} {one}"
    df = spark.createDataFrame([(1, f"{number} {number} 12/25")], "doc_id long, text string")
    assert [(r["n_replaced"], r["kinds"]) for r in pii.report(df, KEY).collect()] == [(2, "card,card")]


def test_account_numbers_before_other_words(spark):
    numbers = ["AL35 2021 1109 0000 0000 0123 4567", "ES91 2100 0418 4502 0005 1332", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    behind = ["", " AND MORE", " AND", " 2021 PLUS", " 4111 1111 1111 1111"]
    got = changed(spark, [n + b for n in numbers for b in behind])
    card = changed(spark, ["4111 1111 1111 1111"])[0]
    for k, number in enumerate(numbers):
        alone, *rest = got[5 * k : 5 * k + 5]
        assert alone != number and rest == [alone + b for b in (*behind[1:4], f" {card}")]


def test_long_runs_of_digits(spark):
    rows = [" ".join(["4111 1111 1111 1111"] * 300), "7" * 200_000, " ".join(["1234"] * 20_000)]
    got = changed(spark, rows)
    assert [len(t) for t in got] == [len(t) for t in rows]
    assert set(got[0].split(" ")) == set(changed(spark, ["4111 1111 1111 1111"])[0].split(" "))


def test_native_plan(spark):
    plan = pii.report(documents(spark, texts(5)), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licences_in_any_layout(spark):
    mit = next(t for n, t in KNOWN if n == "MIT" and t.startswith("Permission"))
    bsd = next(t for n, t in KNOWN if n == "BSD-3-Clause")
    spelled = " * Copyright (c) 2019-2021 Someone Else\n * All rights reserved.\n" + "\n".join(f" * {w}" for w in mit.upper().split(". "))
    rows = [
        (1, mit), (2, spelled), (3, bsd.replace("copyright holder", "copyright owner").replace(";", "")), (4, mit + " And more."),
        (5, "text before\nReleased under the MIT Licence\n\nlicensed under the apache license v2.0"), (6, None), (6, ""), (None, mit), (7, "..."),
        (1, mit), (8, "software " * 20_000),
    ]
    got = license_digest.scan(documents(spark, rows))
    whole = sorted(((r["doc_id"], r["license"]) for r in got.filter("line = 0").collect()), key=repr)
    want = [(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, "BSD-3-Clause"), (4, None), (5, None), (6, None), (6, None), (7, None), (8, None), (None, "MIT")]
    assert whole == sorted(want, key=repr)
    lines = {(r["doc_id"], r["line"], r["license"]) for r in got.filter("line > 0").collect()}
    assert {(5, 2, "MIT"), (5, 4, "Apache-2.0")} <= lines and all(x[0] != 4 for x in lines)
    assert license_digest.scan(documents(spark, [])).count() == 0


def test_own_list_of_licences(spark):
    own = spark.createDataFrame([(hashlib.sha256(b"house rules").hexdigest(), "house")], "known_digest string, license string")
    got = license_digest.scan(documents(spark, [(1, "House -- RULES!")]), own).collect()
    assert [(r["doc_id"], r["line"], r["license"]) for r in got] == [(1, 0, "house")]
