"""Quality of documents by weak supervision: rules vote, nobody vetoes.

Each rule looks at one figure of a text and votes or abstains. Fault rules vote bad where they see their fault and
otherwise abstain, since a text without one fault may have another; ``plain_prose`` votes good where a text looks like
ordinary sentences in several respects. How far a rule can be trusted is not set by hand: expectation-maximisation over
the corpus estimates the accuracy of each rule's votes from how rules confirm and contradict each other, starting from
``ACCURACY``. Good and bad are equally likely before any vote (``BALANCE``; with the share of good documents instead, a
rule that is right about a rare fault and fires alone would lose all trust). A document is kept if its posterior
probability of being good is at least ``KEEP``; without a vote it is. Only a few plain faults (``base_failed``) decide
alone.

Everything that sees a document is a DataFrame expression. The estimation needs only how often each pattern of votes
occurs: at most ``2 ** len(RULES)`` rows, counted over all documents.

Defined cases: a null or empty text has no words and fails; a text without a figure (no line, no word) makes that rule
abstain; rows that repeat, also with a null id, are judged one by one. Without any document nothing is estimated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import materialise

GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5
KEEP = 0.5
BALANCE = 0.5
ACCURACY, PSEUDO_VOTES, PSEUDO_SHARE = 0.85, 50.0, 0.25

#: The vote of each rule where its condition over the figures holds.
RULES: dict[str, tuple[int, str]] = {
    "symbols": (-1, "symbols_per_word > 0.15"),
    "word_length": (-1, "mean_word_length < 2 or mean_word_length > 12"),
    "repeated_words": (-1, "share_repeated_words > 0.15"),
    "repeated_lines": (-1, "share_repeated_lines > 0.3"),
    "capitals": (-1, "share_capital_words > 0.4"),
    "open_lines": (-1, "share_closed_lines < 0.2"),
    "few_words": (-1, "share_distinct_words < 0.1"),
    "no_letters": (-1, "share_words_with_letter < 0.6"),
    "shouting": (-1, "bangs_per_word > 0.2"),
    "plain_prose": (
        1, "symbols_per_word <= 0.02 and mean_word_length between 2.5 and 10 and share_capital_words <= 0.1 "
        "and share_closed_lines >= 0.6 and share_distinct_words >= 0.3 and share_words_with_letter >= 0.85",
    ),
}


def repeated_places(words: Column, keys: Column, bits: Column) -> Column:
    """The places, in order, of the windows that occur twice in the text.

    ``keys`` are the windows' hashes with their place in the lowest ``bits`` bits, in order, so equal windows are
    neighbours. Hash matches are confirmed on the words.
    """

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

    def same(x: Column, y: Column) -> Column:
        equal = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
        return F.coalesce(equal & (F.slice(words, place(x) + 1, WINDOW) == F.slice(words, place(y) + 1, WINDOW)), F.lit(False))

    found = F.filter(keys, lambda x, i: same(x, F.get(keys, i + 1)) | same(F.get(keys, i - 1), x))
    return F.array_sort(F.transform(found, place))


def figures(texts: DataFrame) -> DataFrame:
    """``doc_id``, the counts of the base filter, and the figures the rules look at."""
    split = texts.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({
        "words": F.array_remove(F.split("text", GAP), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    counted = split.withColumn("n", F.size("words")).withColumn("bits", F.length(F.bin(F.col("n").cast("long"))))
    windows = F.when(
        F.col("n") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.col("n") - WINDOW),
            lambda i: F.call_function("shiftleft", F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))), F.col("bits"))
            .bitwiseOR(i.cast("long")),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    keyed = counted.withColumn("keys", F.sort_array(windows))
    placed = keyed.withColumn("places", repeated_places(F.col("words"), F.col("keys"), F.col("bits")))
    width = F.lit(WINDOW)
    steps = F.transform("places", lambda x, i: F.least(width, F.coalesce(F.get("places", i + 1) - x, width)))
    n, lines = F.nullif(F.col("n"), F.lit(0)), F.nullif(F.size("lines"), F.lit(0))
    joined = F.array_join("words", "")
    n_dup_lines = F.size("lines") - F.size(F.array_distinct("lines"))
    n_repeat = F.aggregate(steps, F.lit(0), lambda a, b: a + b)
    n_symbols = F.size(F.split("text", r"[#*$%&|<>]")) - 1
    return placed.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"), n_dup_lines.cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
        (n_symbols / n).alias("symbols_per_word"), (F.length(joined) / n).alias("mean_word_length"),
        (n_repeat / n).alias("share_repeated_words"), (n_dup_lines / lines).alias("share_repeated_lines"),
        (F.size(F.filter("words", lambda w: w.rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$"))) / n).alias("share_capital_words"),
        (F.size(F.filter("lines", lambda x: x.rlike(r"[.!?…][\"'»”)]*[\x20\x09-\x0D]*$"))) / lines).alias("share_closed_lines"),
        (F.size(F.array_distinct("words")) / n).alias("share_distinct_words"),
        (F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))) / n).alias("share_words_with_letter"),
        ((F.size(F.split("text", "!")) - 1) / n).alias("bangs_per_word"),
    )


def vote(name: str) -> Column:
    value, condition = RULES[name]
    return F.when(F.expr(condition), value).otherwise(0).cast("tinyint").alias(f"vote_{name}")


def log_odds(pattern: tuple[int, ...], accuracy: list[float]) -> float:
    """Log odds of being good: every vote counts for its side by the rule's accuracy."""
    return math.log(BALANCE / (1 - BALANCE)) + sum(v * math.log(a / (1 - a)) for v, a in zip(pattern, accuracy, strict=True) if v)


def estimate(patterns: dict[tuple[int, ...], int], rules: int, rounds: int = 200, tolerance: float = 1e-9) -> list[float]:
    """The accuracy of each rule's votes by expectation-maximisation over counted vote patterns.

    A vote that nobody confirms or contradicts leaves its rule as trusted as it was, so nothing would hold a rule with
    a few contradictions. Imagined votes of accuracy ``ACCURACY``, ``PSEUDO_VOTES`` and a ``PSEUDO_SHARE`` of the rule's
    own, do.
    """
    accuracy, ordered = [ACCURACY] * rules, sorted(patterns.items())
    real = [sum(n for pattern, n in ordered if pattern[j]) for j in range(rules)]
    imagined = [PSEUDO_VOTES + PSEUDO_SHARE * n for n in real]
    for _ in range(rounds):
        agreed = [ACCURACY * n for n in imagined]
        for pattern, n in ordered:
            good = 1 / (1 + math.exp(-log_odds(pattern, accuracy)))
            for j, v in enumerate(pattern):
                if v:
                    agreed[j] += n * (good if v > 0 else 1 - good)
        before, accuracy = accuracy, [a / (n + m) for a, n, m in zip(agreed, real, imagined, strict=True)]
        if max((abs(a - b) for a, b in zip(before, accuracy, strict=True)), default=0) < tolerance:
            break
    return accuracy


def posterior(accuracy: list[float]) -> Column:
    """The probability of being good as an expression over the vote columns."""
    odds = F.lit(math.log(BALANCE / (1 - BALANCE)))
    for name, a in zip(RULES, accuracy, strict=True):
        odds = odds + F.col(f"vote_{name}") * math.log(a / (1 - a))
    return 1 / (1 + F.exp(-odds))


def judged(documents: DataFrame) -> DataFrame:
    """Per document row: the counts, whether it fails outright, its posterior quality, and whether it is kept."""
    texts = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    measured = figures(texts)
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    names = [f"vote_{name}" for name in RULES]
    # one pass over the texts; what both later steps need is a few numbers a document
    votes = materialise(measured.select(*base, *map(vote, RULES)), "votes")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = votes.filter(~failed).groupBy(*names).count()
    patterns = {tuple(row[n] for n in names): row["count"] for row in counted.collect()}
    quality = posterior(estimate(patterns, len(RULES)))
    return votes.select(
        *base, failed.alias("base_failed"), (~failed & (quality >= KEEP)).alias("kept"), quality.alias("quality"),
        *(F.col(n) for n in names),
    )


def report(documents: DataFrame) -> DataFrame:
    return judged(documents).drop(*(f"vote_{name}" for name in RULES))
