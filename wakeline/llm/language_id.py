"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary, and every single byte. For each language a piece has a probability;
the probability of a word is the sum, over all ways to cut it into pieces, of the products of their probabilities. A
forward pass over the word's bytes sums them without listing them. The score of a text is the posterior of the best
language over the product of its words, all languages being equally likely beforehand.

Learning: every label that occurs outside the held-out fold; of each at most ``SAMPLE`` documents with a text, chosen by a
hash of their id whatever their length, and of a longer document the first ``LONGEST`` characters. The counts of their
words are summed by Spark, and a few rounds of expectation-maximisation fit the piece probabilities to them. The model is a
table of pieces by languages, whatever the corpus. Everything else covers all texts, whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; words of more than ``WORD`` bytes, such as
the runs of a script without spaces, are learned and scored in stretches of that length; a row without an id is not learned from and counts as held out; a tie goes to the
language that sorts first; without any labelled document every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.exchange import heads
from wakeline.llm.rows import free_name, small_batches
from wakeline.llm.text import SPACED, Slice, column, slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS = 5
SAMPLE, LONGEST = 300, 16_384
WORD, PIECE = 32, 16
ROUNDS = 3
UNKNOWN = "und"

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def pieces_of(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces as bytes, a leading space for the mark of a word's start, and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (
        model.id_to_piece(k).replace("▁", " ").encode()
        for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))
    )
    return sorted({p for p in plain if len(p) <= PIECE and b" " not in p[1:]} | {bytes([b]) for b in range(256)})


def as_slice(strings: list[bytes]) -> Slice:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings], dtype=np.int64)))
    return Slice(np.frombuffer(b"".join(strings), np.uint8), offsets, 0)


class Pieces:
    """Looks pieces up by the hash of their bytes, length by length."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.ids: dict[int, np.ndarray] = {}
        self.known: dict[int, np.ndarray] = {}
        part = as_slice(pieces)
        size = np.diff(part.offsets)
        hashes = part.hashes(part.offsets[:-1], part.offsets[1:])
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            at = at[np.argsort(hashes[at])]
            self.ids[n], self.known[n] = at, hashes[at]

    def starting(self, part: Slice, at: np.ndarray, n: int) -> np.ndarray:
        """The piece of ``n`` bytes at each place, -1 where there is none."""
        hashes = part.hashes(at, at + n)
        known = self.known[n]
        near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[near] == hashes, self.ids[n][near], -1)


def spelled(part: Slice, start: np.ndarray, end: np.ndarray) -> Slice:
    """Words as texts of their own with a space in front, cut into stretches of at most ``WORD`` bytes."""
    size = end - start + 1
    offsets = np.concatenate(([0], np.cumsum(size)))
    data = np.full(offsets[-1], 0x20, np.uint8)
    inside = np.ones(len(data), bool)
    inside[offsets[:-1]] = False
    data[inside] = part.data[np.repeat(start - offsets[:-1] - 1, size)[inside] + np.flatnonzero(inside)]
    return Slice(data, offsets, 0)


def stretches(words: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and word of each stretch."""
    size = np.diff(words.offsets)
    n = -(-size // WORD)
    owner = np.repeat(np.arange(words.n), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = words.offsets[owner] + step * WORD
    return start, np.minimum(WORD, words.offsets[owner + 1] - start), owner


class Lattice:
    """All pieces of some stretches, by how many bytes lie before them."""

    def __init__(self, words: Slice, pieces: Pieces) -> None:
        self.start, self.size, self.owner = stretches(words)
        # long stretches first: those that reach a given place are always the first few
        self.order = np.argsort(-self.size, kind="stable")
        start, size = self.start[self.order], self.size[self.order]
        #: of each place, (bytes of the piece, stretches in ``order``, piece)
        self.edges: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        for place in range(int(size.max()) if len(size) else 0):
            here = []
            for n in pieces.known:
                reach = int(np.searchsorted(-size, -(place + n), side="right"))
                if reach:
                    piece = pieces.starting(words, start[:reach] + place, n)
                    hit = np.flatnonzero(piece >= 0)
                    if len(hit):
                        here.append((n, hit, piece[hit]))
            self.edges.append(here)

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """``[byte, stretch in order, language]``: the summed probability of all cuts of the first bytes."""
        out = np.zeros((len(self.edges) + 1, len(self.order), chance.shape[1]))
        out[0] = 1.0
        for place, here in enumerate(self.edges):
            for n, who, piece in here:
                out[place + n, who] += out[place, who] * chance[piece]
        return out

    def expected(self, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is expected in stretches that occur ``weight[stretch, language]`` times."""
        ahead = self.forward(chance)
        size = self.size[self.order]
        total = ahead[size, np.arange(len(size))]
        back = np.zeros_like(ahead)
        back[size, np.arange(len(size))] = weight[self.order] / total
        counts = np.zeros(chance.shape)
        for place in range(len(self.edges) - 1, -1, -1):
            for n, who, piece in self.edges[place]:
                share = back[place + n, who] * chance[piece]
                np.add.at(counts, piece, share * ahead[place, who])
                back[place, who] += share
        return counts


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: list[bytes]
    chance: np.ndarray  # [piece, language]


def fit(counted: list[tuple[str, bytes, int]], pieces: list[bytes], rounds: int = ROUNDS) -> Model:
    """From ``(language, stretch, count)``, a word's first stretch with a space in front. Every piece keeps the weight of a tenth of an occurrence."""
    languages = sorted({lang for lang, _, _ in counted})
    words = sorted({word for _, word, _ in counted})
    chance = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    if not words:
        return Model(languages, pieces, chance)
    lang = {x: k for k, x in enumerate(languages)}
    counts_of: dict[str, list[tuple[int, int]]] = {}
    for x, word, n in counted:
        counts_of.setdefault(word, []).append((lang[x], n))
    table = Pieces(pieces)
    # the driver's memory is the scarcer one, and a fit has two tables of sums
    step = chunk(4 * len(languages))
    for _ in range(rounds):
        counts = np.full(chance.shape, 0.1)
        for at in range(0, len(words), step):
            some = words[at : at + step]
            weight = np.zeros((len(some), len(languages)))
            for k, word in enumerate(some):
                for x, n in counts_of[word]:
                    weight[k, x] = n
            lattice = Lattice(as_slice(some), table)
            counts += lattice.expected(chance, weight[lattice.owner])
        chance = counts / counts.sum(axis=0)
    return Model(languages, pieces, chance)


def chunk(languages: int) -> int:
    """How many words to look at together, so that a lattice's sums stay at some 20 MB."""
    return max(200, 80_000 // max(1, languages))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.table = model, Pieces(model.pieces)

    def words(self, part: Slice, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log probabilities ``[word, language]``."""
        lattice = Lattice(spelled(part, start, end), self.table)
        ahead = lattice.forward(self.model.chance)
        size = lattice.size[lattice.order]
        logs = np.empty((len(size), len(self.model.languages)))
        logs[lattice.order] = np.log(np.maximum(ahead[size, np.arange(len(size))], 1e-300))
        return np.add.reduceat(logs, np.searchsorted(lattice.owner, np.arange(len(start))))

    def texts(self, part: Slice) -> np.ndarray:
        """Log probabilities ``[text, language]``; every distinct word of the slice is scored once."""
        words = part.words(SPACED)
        out = np.zeros((part.n, len(self.model.languages)))
        if not len(words):
            return out
        order = np.argsort(words.hashes)
        fresh = heads(words.hashes[order])
        first = order[fresh]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        step = chunk(out.shape[1])
        some = [first[k : k + step] for k in range(0, len(first), step)]
        scores = np.concatenate([self.words(part, words.start[x], words.end[x]) for x in some])
        full = words.counts > 0
        out[full] = np.add.reduceat(scores[which], words.first[:-1][full])
        return out


def predicting(model: Model, text_col: str, letter: str, result: str, keep: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            letters = column(batch, letter).to_pylist()
            rows = []
            for part in slices(column(batch, text_col)):
                logs = scorer.texts(part)
                for k in range(part.n):
                    if letters[part.first + k] and model.languages:
                        best = int(np.argmax(logs[k]))
                        rows.append({"lang_pred": model.languages[best], "score": float(1 / np.exp(logs[k] - logs[k, best]).sum())})
                    else:
                        rows.append({"lang_pred": UNKNOWN, "score": 0.0})
            yield pa.RecordBatch.from_arrays([*(column(batch, n) for n in keep), pa.array(rows, _ARROW)], [*keep, result])

    return predict


def remainder(df: DataFrame) -> Column:
    return F.crc32(df["doc_id"].cast("string")) % FOLDS


def learn(labelled: DataFrame, path: str = VOCABULARY) -> Model:
    """A model of the languages of ``labelled(doc_id, text, lang)``, from the documents outside the held-out fold."""
    rows = labelled.filter((remainder(labelled) != 0) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    full = rows.filter(F.octet_length("text") > 0)
    counts = full.groupBy("lang").agg(F.count("*").alias("of"))
    # about twice the sample by a share of the hashes, so that few rows meet where it is cut to size
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit((2 * SAMPLE) << 30) / F.col("of")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = full.join(F.broadcast(counts), "lang").filter(near).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE)
    word = F.explode(F.split(F.left("text", F.lit(LONGEST)), r"[\x20\x09-\x0D]+")).alias("word")
    words = sample.select("lang", word).filter("word <> ''").groupBy("lang", "word").count()
    # the same stretches as in scoring
    spelled_word = F.encode(F.concat(F.lit(" "), "word"), "UTF-8")
    places = F.sequence(F.lit(0), F.floor(F.octet_length("word") / WORD).cast("int"))
    stretch = F.explode(F.transform(places, lambda k: F.substring(spelled_word, k * WORD + 1, F.lit(WORD)))).alias("stretch")
    counted = words.select("lang", stretch, "count").groupBy("lang", "stretch").agg(F.sum("count").alias("n"))
    return fit([(r["lang"], bytes(r["stretch"]), r["n"]) for r in counted.collect()], pieces_of(path))


def predict(documents: DataFrame, model: Model, result: str = "language", keep: list[str] | None = None) -> DataFrame:
    """``documents`` with a struct ``result`` of language and score; ``keep`` names the columns to return (all of them)."""
    keep = documents.columns if keep is None else keep
    letter = free_name("has_letter", result, *documents.columns)
    marked = documents.withColumn(letter, F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField(result, RESULT)])
    return small_batches(marked).mapInArrow(predicting(model, "text", letter, result, list(keep)), schema)


def report(documents: DataFrame) -> DataFrame:
    found = predict(documents.select("doc_id", "text"), learn(documents), keep=["doc_id"])
    return found.select(
        "doc_id", F.coalesce(remainder(found) == 0, F.lit(True)).alias("held_out"), "language.lang_pred", "language.score"
    )


def identified(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a score of at least ``least``, all columns as they are."""
    result = free_name("language", *documents.columns)
    found = predict(documents, learn(documents), result)
    return found.filter((F.col(result)["lang_pred"] != UNKNOWN) & (F.col(result)["score"] >= least)).drop(result)
