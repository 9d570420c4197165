"""Batches of documents that ask buckets of hashes for answers.

Operators that compare every position of a corpus with every other one work in three steps here. Documents are dealt
to batches of a few MB by a hash of their content, so a batch is the same whenever it is computed again. Each batch
sends every bucket one blob with its distinct items; a bucket answers each batch with one bit an item; the batch then
looks at its own texts again with those answers. Copies within a batch travel once, an answer is a bit, and Spark
computes the shuffle of the texts once for all steps.

A batch and a bucket are held in memory by one task, so their sizes are the knobs: with larger executors choose larger
ones, since blobs grow longer and fewer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.rows import keyed_texts, parts_of, small_batches, text_bytes
from wakeline.llm.text import column

BATCH_BYTES = 4 << 20


def dealt(documents: DataFrame, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, int]:
    """``batch, doc_id, text`` and the number of bytes of all texts."""
    texts = small_batches(keyed_texts(documents))
    total = text_bytes(texts)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts_of(total, batch_bytes))).cast("int")
    return texts.select(batch.alias("batch"), "doc_id", "text"), total


def ranked(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and each row's place among them; -1 for a null."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy()
    ordered = np.unique(values[known])
    return ordered, np.where(known, np.searchsorted(ordered, values), -1)


def table_of(ids: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the ids in use, and the places among them in as few bytes as they need."""
    used, place = np.unique(ranks, return_inverse=True)
    return ids[used], place.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)


def by_bucket(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The places of each bucket's items, in their order."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    return list(zip(names.tolist(), np.split(order, first[1:]), strict=True)) if len(names) else []


def heads(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts in an ordered array."""
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return fresh


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def blob_rows(table: pa.Table, *names: str) -> list[tuple]:
    return list(zip(*(column(table, n).to_pylist() for n in names), strict=True))


def table(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(schema.items(), columns, strict=True)})
