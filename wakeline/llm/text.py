"""Words, window fingerprints and compact blobs over Arrow string columns.

These are the small helpers that run inside Spark tasks: a batch of texts is looked at as one byte array and handled
with whole-array operations, in slices of about ``SLICE_BYTES``, so the memory of a task follows the slice (or the
longest single text), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

SLICE_BYTES = 1 << 20

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _RANDOM.integers(1, 2**64 - 1, size=256, dtype=np.uint64)
_STEP = int(_RANDOM.integers(1, 2**62, dtype=np.uint64)) * 8 + 5
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes that separate words: space and 0x09-0x0D, all other bytes belong to a word.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Digits, lower-case letters and every byte above ASCII, for texts whose A-Z are lower-cased first.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, size=n, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(_STEP, -1, 2**64)
        for k, base in enumerate((_STEP % 2**64, inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


class Slice:
    """Some consecutive texts of a batch as bytes. ``offsets[i]:offsets[i + 1]`` are the bytes of text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int) -> None:
        self.data = data
        self.offsets = offsets
        self.first = first
        self.n = len(offsets) - 1
        self._sums: np.ndarray | None = None

    def lowered(self) -> Slice:
        return Slice(_LOWER[self.data], self.offsets, self.first)

    def sums(self) -> np.ndarray:
        """Prefix sums of the polynomial over all bytes, from which any substring's hash follows."""
        if self._sums is None:
            powers, _ = _powers(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data] * powers[: len(self.data)], out=self._sums[1:])
        return self._sums

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the substrings ``start:end``; equal substrings have equal hashes wherever they stand."""
        sums = self.sums()
        _, back = _powers(len(self.data) + 1)
        return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * _PRIME)

    def grams(self, size: int) -> np.ndarray:
        """Hashes of the substrings of ``size`` bytes at every position."""
        sums = self.sums()
        n = len(self.data) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        _, back = _powers(len(self.data) + 1)
        return mix((sums[size:] - sums[:n]) * back[:n])

    def words(self, kind: np.ndarray) -> Words:
        return Words(self, kind)


class Words:
    """The words of a slice: maximal runs of bytes of ``kind`` that stay within one text."""

    def __init__(self, part: Slice, kind: np.ndarray) -> None:
        n = len(part.data)
        self.part = part
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = kind[part.data]
        bounds = part.offsets[:-1][np.diff(part.offsets) > 0]
        before, after = inside[:-2].copy(), inside[2:].copy()
        before[bounds] = False
        if len(bounds):
            after[bounds[bounds > 0] - 1] = False
        here = inside[1:-1]
        self.start = np.flatnonzero(here & ~before)
        self.end = np.flatnonzero(here & ~after) + 1
        #: ``first[i]:first[i + 1]`` are the words of text ``i``
        self.first = np.searchsorted(self.start, part.offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(part.n), self.counts)
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self.part.hashes(self.start, self.end)
        return self._hashes

    def windows(self, size: int) -> np.ndarray:
        """Indices of the words at which a window of ``size`` words of one text starts."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return np.flatnonzero(left >= size)

    def fingerprints(self, at: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
        """Hashes of the ``size`` words from each index in ``at``; other seeds give independent ones."""
        return gram_hash(self.hashes, at, size, seed)


def gram_hash(words: np.ndarray, at: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    total = np.full(len(at), size, dtype=np.uint64) * _PRIME
    for k, factor in enumerate(constants(seed, size)):
        total += words[at + k] * factor
    return mix(total)


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    found = batch.column(name)
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def string_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of a string array; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive texts, as many as fit ``limit`` bytes and one at least."""
    data, offsets = string_parts(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield Slice(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the runs ``start:start + width``."""
    steps = np.bincount(starts, minlength=n + 1).astype(np.int64)
    steps -= np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob. Bytes of equal weight stand together, so small numbers nearly vanish."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.num, len(a)))], dtype=np.int64)
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"" for a in map(np.ascontiguousarray, arrays)]
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(planes))


_TYPES = {np.dtype(t).num: np.dtype(t) for t in ("u1", "u2", "u4", "i4", "i8", "u8")}
_TYPES[np.dtype(np.uint64).num] = np.dtype(np.uint64)
_TYPES[np.dtype(np.int64).num] = np.dtype(np.int64)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 2 * n)[1:].reshape(n, 2)
    out, at = [], 8 * (1 + 2 * n)
    for kind, size in head:
        dtype = _TYPES[int(kind)]
        total = int(size) * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, total, at).reshape(dtype.itemsize, int(size))
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if total else np.zeros(0, dtype))
        at += total
    return out


def gaps(ordered: np.ndarray) -> np.ndarray:
    """Steps between ascending numbers; ``np.cumsum`` undoes it."""
    return np.diff(ordered, prepend=ordered.dtype.type(0)) if len(ordered) else ordered
