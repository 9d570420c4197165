"""Small documents with everything that goes wrong in tables."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Clashing names of all sorts: ours, Spark's, and those of the result columns.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch int, n_words string, hits array<int>, place long"


def texts(seed: int = 1, n: int = 60, words: int = 120) -> list[tuple[int | None, str | None]]:
    """Texts with shared passages, exact and near copies, ties, repeated rows, nulls, empty and long ones."""
    rng = random.Random(seed)
    vocabulary = [w for k in range(400) for w in (f"w{k}", f"Wörd{k}")]
    passage = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(4)]
    rows: list[tuple[int | None, str | None]] = []
    for k in range(n):
        body = rng.choices(vocabulary, k=rng.randint(1, words))
        if k % 4 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = rng.choice(passage).split()
        if k % 7 == 3:
            body = rows[k - 2][1].split() if rows[k - 2][1] else body
        if k % 9 == 5 and rows[k - 1][1]:
            body = rows[k - 1][1].split()
            for _ in range(max(1, len(body) // 40)):
                body[rng.randrange(len(body))] = rng.choice(vocabulary)
        rows.append((k * 3, rng.choice(["", " ", "\n"]) + rng.choice([" ", "\n", "\t "]).join(body)))
    again = rows[8]
    rows += [
        (None, rows[4][1]), (None, None), (500, None), (501, ""), (502, " \t\n "), (503, "one"), again, again,
        (again[0], "another text of the same id " * 4), (504, " ".join(rng.choices(vocabulary, k=9000))),
        (505, "x" * 5000), (506, "same same " * 40), (507, "\x00odd\x00 bytes ￿ 😀 " * 6), (-7, rows[12][1]),
        (508, " ".join(rows[8][1].split() * 3)),
    ]
    return rows


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]], parts: int = 3) -> DataFrame:
    full = [(i, t, None if k % 5 == 0 else "en", None, k, k % 2, None, None, None) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def as_set(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in a comparable order."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
