"""Whole Arrow batches of text as numpy arrays: words, word hashes and word n-gram hashes.

A text column reaches a task as one byte buffer with offsets, so words of many documents are
found and hashed with a few array operations instead of a Python loop over tokens.  Words are
the maximal runs outside ``[\\x20\\x09-\\x0D]``; A-Z can be folded to lower case, nothing else.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # small enough for a core's cache, and for freed arrays to be used again

# The white-space bytes: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def release_memory() -> None:
    """Give freed memory back to the system: Arrow's pool and, with glibc, the C heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run: Callable) -> Callable:
    """A mapInArrow kernel that releases its memory when its task ends.  Workers wait for other
    tasks with what they once held, so a session's executors grow from stage to stage without."""
    def kernel(batches):
        try:
            yield from run(batches)
        finally:
            _shrink_power_tables()
            release_memory()
    return kernel


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += _GOLD
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Doubles in (0, 1) from 64-bit hashes (the upper 53 bits)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_BYTE_CODE = mix(np.arange(256, dtype=np.uint64))
_powers = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _power_tables(n: int):
    """BASE**i and BASE**-i modulo 2**64 for i < n, grown by doubling and kept per worker."""
    if _powers["n"] < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            have = 1
            with np.errstate(over="ignore"):
                while have < size:
                    step = np.uint64(pow(base, have, 1 << 64))
                    m = min(have, size - have)
                    out[have:have + m] = out[:m] * step
                    have += m
            _powers[key] = out
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def _shrink_power_tables() -> None:
    """Forget tables longer than a chunk of usual size: one very long text made them."""
    if _powers["n"] > 4 * CHUNK_BYTES:
        _powers.update(n=0, up=np.zeros(0, np.uint64), down=np.zeros(0, np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of text (one longer text stays whole):
    (rows, bytes, offsets).  Bounds a task's memory whatever the batch size is."""
    for batch in batches:
        data, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield (batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]],
                   offsets[lo:hi + 1] - offsets[lo])
            lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word, in order."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


class SpanHasher:
    """64-bit hashes of byte spans of one buffer: a polynomial over random byte codes, from prefix
    sums that are made once."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.prefix[end] - self.prefix[start]) * self.down[start]
            return mix(h + (end - start).astype(np.uint64) * _GOLD)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return SpanHasher(data)(start, end)


def ngram_hashes(word_hash: np.ndarray, doc: np.ndarray, n_docs: int,
                 n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds): every run of ``n`` words of a document, document by document; a document
    with 1 to n-1 words has its whole sequence as one.  ``bounds`` has n_docs + 1 entries."""
    total = len(word_hash)
    count = np.bincount(doc, minlength=n_docs)
    per_doc = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.zeros(n_docs + 1, np.int64)
    np.cumsum(per_doc, out=bounds[1:])
    if total == 0:
        return np.zeros(0, np.uint64), bounds
    first = np.zeros(n_docs, np.int64)
    np.cumsum(count[:-1], out=first[1:])
    pos = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first, per_doc)
    length = np.repeat(np.minimum(count, n), per_doc)
    acc = np.zeros(len(pos), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            used = j < length
            w = word_hash[np.minimum(pos + j, total - 1)]
            acc = np.where(used, mix(acc * _M1 + w), acc)
    return acc, bounds
