"""Tokenising and hashing for batches of whole texts, and cutting Arrow batches to a bounded size."""

from __future__ import annotations

import ctypes
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: White space of the word and line rules: 0x20 and 0x09-0x0D.
SPACE = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 4 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library
    _LIBC = None


def words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; bytes.lower and bytes.split know ASCII only, as the rule does."""
    return text.encode().lower().split() if text else []


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks, and would keep the most they ever had."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, and a release at its end."""
    try:
        yield from batches
    finally:
        release()


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices whose texts have about limit bytes at most; a longer text stands alone."""
    for batch in each(batches):
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0), dtype=np.int64)
        total, start = 0, 0
        for i, n in enumerate(size.tolist()):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                total, start = 0, i
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def encode(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Codes of all words in order, offsets of the texts in them, and the distinct words by code."""
    known: defaultdict = defaultdict()
    known.default_factory = known.__len__
    code, parts, ends = known.__getitem__, [], [0]
    for text in texts:
        w = words(text)
        parts.append(np.fromiter(map(code, w), np.int32, len(w)))
        ends.append(ends[-1] + len(w))
    known.default_factory = None  # the cycle would keep all words until some later garbage collection
    return np.concatenate(parts) if parts else np.empty(0, np.int32), np.asarray(ends, np.int64), list(known)


def hashes(distinct: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one text, given its words' hashes; a shorter text is one shingle."""
    if not len(h):
        return np.empty(0, np.uint64)
    n = min(width, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i] + np.uint64(i + 1))
    return np.unique(out)

