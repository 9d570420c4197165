"""Token counts of documents in flat token files, by scanning for separators.

A flat file holds 16-bit token ids, document after document, each followed by the end-of-document id, and no index. It
is stored in blocks of a fixed number of tokens that know nothing of documents. Every block is searched on its own as
one array; what remains open at its ends is stitched over the blocks of the file by a prefix scan: tokens before the
block, documents that ended before it, and where the last of them ended. The scan runs in two levels, over spans of
``SPAN`` blocks and over the spans of a file, so no task orders all blocks of a large file.

:func:`write_files` makes such files from a table of documents with a public byte-level vocabulary. Its manifest only
names the documents in the order they were written; counts come from the scan.

Defined cases: a null or empty text is a document of no tokens; a text that spells a special token is ordinary text;
rows that repeat, also without an id, are documents of their own; a file that does not end in a separator has an open
last document, which is reported by ``documents_in`` with ``closed`` false.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.rows import small_batches
from wakeline.llm.text import column
from wakeline.session import materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
BLOCK_TOKENS = 1 << 19
SPAN = 4096
#: How the public vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    pairs = map(bytes.split, Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def writer(ranks: dict[bytes, int], block_tokens: int):
    """Blocks of the file this task writes, and the ids of its documents in order."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).encode_ordinary
        file, block, written = TaskContext.get().partitionId(), 0, 0
        names = ["file", "block", "tokens", "first", "doc_ids"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]

        def rows(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        open_block: list[np.ndarray] = []
        size = 0
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            yield rows(file, None, None, written, ids)
            written += len(ids)
            for text in column(batch, "text"):
                tokens = np.append(np.array(encode(text.as_py() or ""), np.uint16), np.uint16(END))
                open_block.append(tokens)
                size += len(tokens)
                if size >= block_tokens:
                    flat = np.concatenate(open_block)
                    while len(flat) >= block_tokens:
                        yield rows(file, block, flat[:block_tokens].tobytes(), None, None)
                        block, flat = block + 1, flat[block_tokens:]
                    open_block, size = [flat], len(flat)
        if size:
            yield rows(file, block, np.concatenate(open_block).tobytes(), None, None)

    return write


def write_files(documents: DataFrame, path: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Flat token files, one for each task, as ``file, block, tokens``; and ``file, ordinal, doc_id``."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = materialise(
        small_batches(texts).mapInArrow(
            writer(vocabulary(path), block_tokens), "file long, block long, tokens binary, first long, doc_ids array<long>"
        ),
        "tokens",
    )
    blocks = stored.filter("block is not null").select("file", "block", "tokens")
    manifest = stored.filter("block is null").select("file", "first", F.posexplode("doc_ids").alias("at", "doc_id"))
    return blocks, manifest.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "doc_id")


def separators(end: int):
    """Of each block, how many tokens it has and at which of them a document ends."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(b.as_buffer(), np.uint16) for b in column(batch, "tokens")]
            ends = [np.flatnonzero(t == end) for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "file"), column(batch, "block"), pa.array(list(map(len, tokens)), pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                ["file", "block", "n", "ends"],
            )

    return scan


def documents_in(blocks: DataFrame, end: int = END) -> DataFrame:
    """``file, ordinal, n_tokens, closed`` of every document in the files, in the order of the file."""
    found = blocks.select("file", "block", "tokens").mapInArrow(separators(end), "file long, block long, n long, ends array<long>")
    span = F.expr(f"block div {SPAN}")
    here = found.withColumn("span", span)
    in_span = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over_spans = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)

    def total(x: str | Column, w) -> Column:
        return F.coalesce(F.sum(x).over(w), F.lit(0))

    local = here.select(
        "file", "span", "block", "n", "ends", total("n", in_span).alias("start"), total(F.size("ends"), in_span).alias("done"),
    ).withColumn("last", F.col("start") + F.array_max("ends"))
    local = local.withColumn("before", F.max("last").over(in_span))
    spans = local.groupBy("file", "span").agg(
        F.sum("n").alias("n_span"), F.sum(F.size("ends")).alias("docs_span"), F.max("last").alias("last_span"), F.max("block").alias("top"),
    )
    base = spans.withColumns({"at": total("n_span", over_spans), "docs": total("docs_span", over_spans)})
    base = base.withColumn("earlier", F.max(F.col("at") + F.col("last_span")).over(over_spans))
    joined = local.join(base.select("file", "span", "at", "docs", "earlier"), ["file", "span"])
    # places within the file: of the block, and of the end of the last document before it
    start = F.col("at") + F.col("start")
    opened = F.coalesce(F.col("at") + F.col("before"), F.col("earlier"), F.lit(-1).cast("long"))
    placed = joined.select("file", start.alias("start"), (F.col("docs") + F.col("done")).alias("docs"), opened.alias("opened"), "ends")
    each = placed.select("file", "start", "docs", "opened", "ends", F.posexplode("ends").alias("k", "at"))
    previous = F.when(F.col("k") > 0, F.col("start") + F.get("ends", F.col("k") - 1)).otherwise(F.col("opened"))
    closed = each.select(
        "file", (F.col("docs") + F.col("k")).alias("ordinal"), (F.col("start") + F.col("at") - previous - 1).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    files = spans.withColumns({"at": total("n_span", over_spans)}).groupBy("file").agg(
        F.sum("n_span").alias("n"), F.sum("docs_span").alias("ordinal"), F.max(F.col("at") + F.col("last_span")).alias("last"),
    )
    rest = F.col("n") - 1 - F.coalesce("last", F.lit(-1))
    unclosed = files.filter(rest > 0).select("file", "ordinal", rest.alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(unclosed)


def token_counts(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens`` of every document row, counted in the flat files written from the documents."""
    blocks, order = write_files(documents, path)
    return order.join(documents_in(blocks), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
