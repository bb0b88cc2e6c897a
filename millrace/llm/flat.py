"""Texts of an Arrow batch as one flat array of bytes: spans of words and lines, and 64-bit hashes of spans.

Nothing here loops over words. Batches are cut to ``BLOCK`` bytes before they are expanded, and hashes are computed a
block at a time, so that memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

# The bytes 0x20 and 0x09 to 0x0D part words.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = (1 << 64) - 1
_BYTES = np.random.default_rng(20240115).integers(1, _WORD, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _tables or len(_tables[0]) < n:
        n = max(n, BLOCK + 1)
        _tables[:] = [_powers(_BASE, n), _powers(_INVERSE, n)]
    return _tables[0], _tables[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets, one more than rows. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory back that Python workers no longer use: they live on beyond a task, beside a heap of fixed size."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def pieces(batch: pa.RecordBatch, column: str, most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each, or a single row."""
    _, offsets = texts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    release()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and for each text the number of words before it (one more)."""
    inside = ~SPACES[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(data))])  # texts follow each other without a gap
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines of all texts, split at newlines, and for each text the lines before it (one more)."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    owner = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = ends[np.lexsort((ends, np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])))]
    return starts, ends, np.searchsorted(owner, np.arange(len(offsets)))


def _long_hash(data: np.ndarray) -> int:
    total, power = 0, powers(BLOCK)[0]
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK]
        total += int(np.sum(_BYTES[part] * power[: len(part)], dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return total & _WORD


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = int(np.searchsorted(ends, base + BLOCK, "right"))
        if stop <= at:
            out[at] = _long_hash(data[base : ends[at]])
            at += 1
            continue
        part = data[base : ends[stop - 1]]
        power, inverse = powers(len(part))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = (sums[e] - sums[s]) * inverse[s]
        at = stop
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


_STEP = 0xD6E8FEB86659FD93 | 1


def runs(items: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` items that stay within their text, and the index of each run's first item."""
    if len(items) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(items) - length + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        total += items[k : k + n] * np.uint64(pow(_STEP, k + 1, 1 << 64))
    within = np.ones(n, dtype=bool)
    for k in range(1, length):  # a run may not begin less than its length before the end of its text
        last = first[1:] - k
        within[last[(last >= 0) & (last < n)]] = False
    at = np.flatnonzero(within)
    return mix(total[at]), at


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each item, from the number of items before each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values per text."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
