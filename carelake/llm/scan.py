"""Words, hashes and shingles of whole texts, computed on the byte buffers of Arrow text columns.

Everything here works on bounded slices of a batch and has no per-row Python apart from loops over documents.
Hashes are 64 bits wide; two different words or shingles share one with probability 2**-64 per pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time (a longer text is handled alone, its words in blocks of this size).
CHUNK = 1 << 20
SHINGLE = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE_BASE, _WORD_BASE = 0x5851F42D4C957F2D, 0xD6E8FEB86659FD93


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Bytes that separate words: space and 0x09 to 0x0D.
BLANK = _table(bytes([32, *range(9, 14)]))
#: Bytes that separate words made of letters only (all bytes beyond ASCII count as letters).
NON_LETTER = _table(bytes(i for i in range(128) if not chr(i).isalpha()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def release() -> None:
    """Give freed memory back to the system: a worker lives on after its task, beside the next stage's executor memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, with its memory released at its end, also an early one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release()

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    h = h + _ODD
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def mix_one(value: int) -> int:
    return int(mix(np.array([value & (2**64 - 1)], np.uint64))[0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def chunks(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, document offsets) over slices of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(off, off[first] + (size or CHUNK), "right")) - 1)
        yield first, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per document) of the runs of non-separators; no word spans two documents."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = off[(off > 0) & (off < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int | None = None) -> np.ndarray:
    """One hash per word, of its bytes, or of its first ``longest`` bytes."""
    lens = ends - starts if longest is None else np.minimum(ends - starts, longest)
    out = np.empty(len(starts), np.uint64)
    total = np.concatenate(([0], np.cumsum(lens)))
    powers = _powers(_BYTE_BASE, int(lens.max()) if len(lens) else 0)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + CHUNK, "right")) - 1)
        n = lens[i:j]
        first = total[i:j] - total[i]
        within = np.arange(total[j] - total[i]) - np.repeat(first, n)
        values = (data[within + np.repeat(starts[i:j], n)].astype(np.uint64) + np.uint64(1)) * powers[within]
        out[i:j] = np.add.reduceat(values, first)
        i = j
    return mix(out + lens.astype(np.uint64) * _ODD)


def shingles(hashes: np.ndarray, word_off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per document) of all runs of ``k`` words; with fewer words, the whole sequence is the only one."""
    m = np.diff(word_off)
    count = np.where(m >= k, m - k + 1, np.minimum(m, 1))
    out_off = np.concatenate(([0], np.cumsum(count)))
    if not out_off[-1]:
        return np.zeros(0, np.uint64), out_off
    powers = _powers(_WORD_BASE, k)
    padded = np.concatenate((hashes, np.zeros(k, np.uint64)))
    window = np.zeros(len(hashes), np.uint64)
    for j in range(k):
        window += padded[j : j + len(hashes)] * powers[j]
    out = window[np.arange(out_off[-1]) + np.repeat(word_off[:-1] - out_off[:-1], count)]
    for d in np.flatnonzero((m > 0) & (m < k)):
        out[out_off[d]] = np.sum(hashes[word_off[d] : word_off[d + 1]] * powers[: m[d]] + _powers(_BYTE_BASE, 8)[m[d] : m[d] + 1])
    return mix(out), out_off


def shingle_sets(column: pa.Array, lower: bool = False, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``k``-word shingles; empty without words."""
    for _, data, off in chunks(column):
        data = LOWER[data] if lower else data
        starts, ends, word_off = words(data, off)
        h, h_off = shingles(word_hashes(data, starts, ends), word_off, k)
        for i in range(len(off) - 1):
            yield np.unique(h[h_off[i] : h_off[i + 1]])


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each [off[i], off[i+1])."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[off[1:]] - total[off[:-1]]
