"""Licences by canonical digest.

A text is brought to a canonical form (lower case, no copyright lines, one spelling of words that licences spell
differently, words parted by single spaces without punctuation), and the digest of the whole form is joined to the digests
of known licence texts. Documents that are a licence, whatever their layout, year and holder, match as a whole. Notices
inside a document are found the same way, paragraph line by line: every line's whole canonical form is looked up.

The digests of the known texts are made by the same expressions. Documents are not shuffled by their texts: only the
digests of distinct candidate lines (those in which a licence word occurs) travel, and the join on digests is a plain
equi-join whose sides Spark sizes itself.

Defined cases: a null or empty text, or one of punctuation only, has the digest of the empty text and no licence; rows
that repeat are reported each, also without an id; a text known under two licences reports the first by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.license_texts import KNOWN

#: Spellings that count as one, after lower-casing, and what they become.
SPELLINGS = (
    (r"https", "http"),
    (r"&", " and "),
    (r"\band/or\b", "and or"),
    (r"licence", "license"),
    (r"sub-license", "sublicense"),
    (r"non-infringement", "noninfringement"),
    (r"acknowledgement", "acknowledgment"),
    (r"favour", "favor"),
    (r"copyright (?:holder|owner)s?", "copyright holder"),
    (r"merchantibility", "merchantability"),
    (r"while\b", "whilst"),
    (r"per cent", "percent"),
    (r"organisation", "organization"),
    (r"v(?:ersion|\.)? ?([0-9])", "version $1"),
)
#: Lines that name a holder or reserve rights, with or without comment marks in front.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
#: Every known notice has one of these words, so only lines that have one are looked up on their own.
LICENCE_WORD = r"(?i)licen[sc]|permission|redistribution|software"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for pattern, word in SPELLINGS:
        out = F.regexp_replace(out, pattern, word)
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``known_digest, license`` of each known text."""
    texts = spark.createDataFrame(list(known), "license string, text string")
    return texts.select(digest(F.col("text")).alias("known_digest"), "license").groupBy("known_digest").agg(F.min("license").alias("license"))


def units(documents: DataFrame) -> DataFrame:
    """``doc_id, line, canonical_sha256``: line 0 is the whole text, others are lines with a licence word."""
    text = F.col("text")
    lines = F.filter(
        F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).cast("long").alias("line"), x.alias("text"))),
        lambda x: x["text"].rlike(LICENCE_WORD),
    )
    whole = F.array(F.struct(F.lit(0).cast("long").alias("line"), text.alias("text")))
    texts = documents.select(F.col("doc_id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    parts = texts.select("doc_id", F.explode(F.concat(whole, lines)).alias("part"))
    return parts.select("doc_id", F.col("part")["line"].alias("line"), digest(F.col("part")["text"]).alias("canonical_sha256"))


def scan(documents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document row its whole text (line 0) with the licence it is, or null; and each line that is a known notice.

    ``known(known_digest, license)`` defaults to the texts of ``license_texts``, a fixed list that is broadcast.
    """
    known = F.broadcast(known_digests(documents.sparkSession)) if known is None else known
    found = units(documents).join(known, F.col("canonical_sha256") == F.col("known_digest"), "left")
    return found.filter("line = 0 or license is not null").select("doc_id", "line", "canonical_sha256", "license")
