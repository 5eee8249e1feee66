"""Vectorised text kernels shared by the operators: words, hashes, shingles.

All kernels work on the data buffer of an Arrow string column, a block of a
quarter MB at a time, so a task's memory follows the block (or the longest document),
never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
_HASH_BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_U64 = np.uint64
_MASK = (1 << 64) - 1

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words ``[^\x20\x09-\x0D]+``.
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True


def _powers(base: int) -> np.ndarray:
    out = np.full(_HASH_BLOCK + 1, _U64(base), dtype=_U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE), _powers(_BASE_INV)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h ^ (h >> _U64(30))
    h = h * _U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U64(27))
    h = h * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of an Arrow string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=column.offset + len(column) + 1)[column.offset:]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
                block: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into slices of about ``block`` text bytes, whole rows each."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(column))
        n, lo = batch.num_rows, 0
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + block, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            lo = hi
        # workers live on after a task; what Arrow holds for them counts against the executor
        pa.default_memory_pool().release_unused()


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes of a class; runs end at row ends."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    is_in = inside[data]
    first = is_in.copy()
    first[1:] &= ~is_in[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = is_in[edges]
    last = is_in.copy()
    last[:-1] &= ~is_in[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = is_in[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for sorted starts and sorted ends."""
    at_start = np.zeros(len(starts), dtype=_U64)
    at_end = np.zeros(len(starts), dtype=_U64)
    inverse = np.ones(len(starts), dtype=_U64)
    carry, scale, unscale = 0, 1, 1
    for lo in range(0, len(data), _HASH_BLOCK):
        part = data[lo:lo + _HASH_BLOCK]
        sums = np.empty(len(part) + 1, dtype=_U64)
        sums[0] = 0
        np.cumsum((part.astype(_U64) + _U64(1)) * _POW[:len(part)], out=sums[1:])
        a, b = np.searchsorted(starts, [lo, lo + len(part)])
        at = starts[a:b] - lo
        at_start[a:b] = sums[at] * _U64(scale) + _U64(carry)
        inverse[a:b] = _INV[at] * _U64(unscale)
        a, b = np.searchsorted(ends, [lo, lo + len(part)], side="right")
        at_end[a:b] = sums[ends[a:b] - lo] * _U64(scale) + _U64(carry)
        carry = (carry + int(sums[-1]) * scale) & _MASK
        scale = scale * pow(_BASE, len(part), 1 << 64) & _MASK
        unscale = unscale * pow(_BASE_INV, len(part), 1 << 64) & _MASK
    return mix((at_end - at_start) * inverse + (ends - starts).astype(_U64) * _U64(0xD6E8FEB86659FD93))


def rows_of(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Row that holds each byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


def row_edges(rows: np.ndarray, n: int) -> np.ndarray:
    """n + 1 borders of the (sorted) row numbers."""
    return np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))).astype(np.int64)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of aligned hash columns."""
    h = np.zeros(len(parts[0]), dtype=_U64)
    for x in parts:
        h = (h ^ x) * _U64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> _U64(32))
    return mix(h)


def shingles(word_hash: np.ndarray, edges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, and the n + 1 borders by row.

    A row with 1 to k - 1 words has one shingle, its whole sequence.
    """
    n = len(edges) - 1
    counts = np.diff(edges)
    row = np.repeat(np.arange(n), counts)
    m = len(word_hash)
    if m >= k:
        full = row[:m - k + 1] == row[k - 1:]
        h = combine([word_hash[i:m - k + 1 + i] for i in range(k)])[full]
        owner = row[:m - k + 1][full]
    else:
        h, owner = np.empty(0, _U64), np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        seeds = np.array([int(combine([word_hash[j:j + 1] for j in range(edges[i], edges[i + 1])]
                                      + [np.array([counts[i]], _U64)])[0]) for i in short], dtype=_U64)
        at = np.searchsorted(owner, short)
        h, owner = np.insert(h, at, seeds), np.insert(owner, at, short)
    return h, row_edges(owner, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACE_WORD,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in order, their starts and ends (bytes), and borders by row."""
    if lower:
        data = LOWER[data]
    starts, ends = spans(data, offsets, inside)
    edges = row_edges(rows_of(offsets, starts), len(offsets) - 1)
    return span_hash(data, starts, ends), starts, ends, edges


def chars_before(data: np.ndarray) -> np.ndarray:
    """For each byte position 0..len, the code points that begin before it."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))


def hash_of(word: str) -> int:
    """The hash that ``word_hashes`` gives this word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hash(raw, np.array([0]), np.array([len(raw)]))[0])
