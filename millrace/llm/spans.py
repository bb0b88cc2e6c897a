"""Spans of bytes that a mask keeps, and their CRC-32, for all texts of an Arrow batch at once.

Nothing here loops over spans but for those longer than ``LONG`` bytes.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Spans beyond this many bytes are summed up one by one.
LONG = 64

# The reflected polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320


def _table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_TABLE = _table()


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are inside, and for each text the runs before it (one more).

    Texts follow each other without a gap; a run ends with its text.
    """
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(inside))])
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray | None = None) -> np.ndarray:
    """The unsigned CRC-32 of each span, which may overlap; ``state`` has the checksums of what goes before each."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    size = ends - starts
    order = np.argsort(np.minimum(size, LONG + 1).astype(np.uint8), kind="stable")[::-1]
    longer = np.cumsum(np.bincount(np.minimum(size, LONG + 1), minlength=LONG + 2)[::-1])[::-1]  # spans of k bytes or more
    begin = starts[order]
    before = np.zeros(len(starts), np.uint32) if state is None else state.astype(np.uint32)
    now = ~before[order]
    n_long = int(longer[LONG + 1])
    for k in range(LONG):
        n = int(longer[k + 1])
        if n <= n_long:
            break
        part = now[n_long:n]
        now[n_long:n] = _TABLE[(part ^ data[begin[n_long:n] + k]) & 255] ^ (part >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~now
    for i in order[:n_long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]], int(before[i]))
    return out
