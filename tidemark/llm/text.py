"""Numpy helpers over Arrow text columns: prefix hashes, tokens, slices.

All texts of a slice lie in one byte buffer. ``prefix_hashes`` gives running
polynomial hashes (mod 2**64, random value per byte) from which the hash of
any byte span follows in constant time.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 2 << 20
SPACE, SYMBOL, WORD = 0, 1, 2


def byte_values(seed: int = 7) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)


def byte_classes(symbols: bool) -> np.ndarray:
    """White space, words (letters, digits, non-ASCII) and, if asked for, symbols.
    Without ``symbols`` everything but white space belongs to words."""
    c = np.full(256, SYMBOL if symbols else WORD, np.uint8)
    c[[9, 10, 11, 12, 13, 32]] = SPACE
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        c[lo:hi] = WORD
    return c


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, mod 2**64."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


class Hasher:
    """Prefix hashes of byte buffers; keeps its power tables between buffers."""

    def __init__(self, base: int = BASE, seed: int = 7):
        self.values, self.base = byte_values(seed), base
        self.up, self.down = powers(1, base)

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(buf):
            self.up, self.down = powers(len(buf) + 1 + len(buf) // 4, self.base)
        h = np.zeros(len(buf) + 1, np.uint64)
        np.take(self.values, buf, out=h[1:])
        h[1:] *= self.up[:len(buf)]
        return np.cumsum(h, out=h)

    def spans(self, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((h[end] - h[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(texts: list[str]) -> list[bytes]:
    """The UTF-8 bytes of the lower-cased texts, as ``text_buffers`` lower-cases them."""
    return [t.encode() for t in pc.utf8_lower(pa.array(texts, pa.string())).to_pylist()]


def text_buffers(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, lower-cased if asked for; null counts as empty."""
    if lower:
        column = pc.utf8_lower(column)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]] if len(column) else data[:0], off - off[0] if len(column) else off[:1]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """(first, last + 1) document of consecutive slices of about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def small_batches(batches, column: str = "text", limit: int = SLICE_BYTES):
    """The record batches cut into parts of about ``limit`` bytes of text (one row at least),
    so that what is worked on and what is sent on stay small however large a batch is."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for i, j in slices(np.append(0, np.cumsum(size, dtype=np.int64)), limit):
            yield batch.slice(i, j - i)


def tidy(run):
    """``run`` (batches -> batches) that gives the memory of its task back to the system: workers
    are used again, and what they keep would add to the next stage's."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):          # no glibc
                pass
    return tidied


def tokens(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one byte class, white space left out.

    Returns starts, ends, class of each run, and the first run of each document
    (one more entry for the end). Runs never cross documents.
    """
    n = len(buf)
    kind = classes[buf]
    edge = np.empty(n, bool)
    edge[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < n]] = True
    runs = np.flatnonzero(edge)
    ends = np.append(runs[1:], n)
    kinds = kind[runs]
    full = kinds != SPACE
    starts, ends, kinds = runs[full], ends[full], kinds[full]
    return starts, ends, kinds, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each run, from the first run of each document."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
