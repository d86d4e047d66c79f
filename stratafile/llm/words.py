"""Words of whole Arrow columns as numpy arrays: positions and 64-bit hashes, without one Python object per word.

Texts are looked at as UTF-8 bytes. All separators in use are ASCII, so no separator lies within a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multipliers of the two polynomial hashes (over the bytes of a word, over the words of a window).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes that one round of the vector code takes, unless a single text is longer.
ROUND_BYTES = 2 << 20
#: Bytes that the running sum of the hashes takes at a time.
SEGMENT_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n-1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        factors = np.full(size, base & 0xFFFFFFFFFFFFFFFF, U64)
        factors[0] = 1
        _powers[base] = have = np.cumprod(factors, dtype=U64)
    return have[:n]


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each begins (one offset more than there are texts). Null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def rounds(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = ROUND_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text; a longer text is a slice of its own. In the end the memory
    that Arrow has kept for reuse goes back, since workers wait for their next task with what they hold."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            base = ends[at] - lengths[at]
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """Words of a slice of texts: byte spans, the index of each text's first word, and a hash for each word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # text i has the words first[i] .. first[i + 1]
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]  # a text that ends in a word doesn't run into the next
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in the order of their starts, from a running sum over one segment after the other, so
    that a text of any length takes arrays of bounded size (a longer span is a segment of its own)."""
    out = np.zeros(len(starts), U64)
    inverse = pow(BYTE_BASE, -1, 1 << 64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, base + SEGMENT_BYTES)))
        segment = data[base : ends[i:j].max()]
        sums = segment.astype(U64)
        sums += U64(1)
        sums *= powers(BYTE_BASE, len(sums))
        np.cumsum(sums, out=sums)
        a, b = starts[i:j] - base, ends[i:j] - base
        before = np.where(a > 0, sums[a - 1], U64(0))
        out[i:j] = (sums[b - 1] - before) * powers(inverse, len(sums))[a]
        i = j
    return mixed(out + (ends - starts).astype(U64))


def words_of(column: pa.Array, lower: bool = False, separators: np.ndarray = SPACES) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, first = spans(data, offsets, separators)
    return Words(data, offsets, starts, ends, first, span_hashes(data, starts, ends))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive word hashes; the caller leaves out those that cross an edge of a text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for j, p in enumerate(powers(WORD_BASE, k)):
        total += hashes[j : j + n] * p
    return mixed(total, k)


def sequence_hash(hashes: np.ndarray) -> int:
    """The hash of a whole word sequence; differs from that of a window of another length."""
    return int(mixed(np.array([(hashes * powers(WORD_BASE, len(hashes))).sum(dtype=U64)], U64), len(hashes))[0])
