"""Suffix arrays by induced sorting and permuted common prefixes, a bucket at a time over flat arrays.

Suffixes are classified as larger or smaller than their successor; leftmost-smaller suffixes split the text into
substrings, which are sorted by induction and named; names that repeat are sorted recursively, each level over twice
the names of the last; the order of the leftmost-smaller suffixes then induces that of all suffixes in two linear
passes. Both passes take the entries of a bucket together, as they only write to places that are read later.
"""

from __future__ import annotations

import numpy as np


def _smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last symbol is the least and occurs once."""
    n = len(s)
    turn = np.flatnonzero(s[:-1] != s[1:])
    nxt = np.repeat(turn, np.diff(turn, prepend=-1))
    out = np.ones(n, dtype=bool)
    out[:-1] = s[nxt] < s[nxt + 1]
    return out


def _induce(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from ``leftmost``, leftmost-smaller suffixes in their order."""
    n, buckets = len(s), len(start)
    order = np.full(n, -1, dtype=np.int64)
    held = np.bincount(s[leftmost], minlength=buckets)
    first = end - held
    by = np.argsort(s[leftmost], kind="stable")
    seeds = leftmost[by]
    order[np.repeat(first - (np.cumsum(held) - held), held) + np.arange(len(seeds))] = seeds

    def dealt(batch: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        j = batch[batch > 0] - 1
        j = j[small[j] == want]
        symbols = s[j]
        by = np.argsort(symbols, kind="stable")
        count = np.bincount(symbols, minlength=buckets)
        symbols = symbols[by]
        return j[by], symbols, np.arange(len(j)) - (np.cumsum(count) - count)[symbols], count

    head = start.copy()
    for c in range(buckets):
        done = start[c]
        while done < head[c]:
            batch, done = order[done : head[c]], head[c]
            j, symbols, rank, count = dealt(batch, False)
            order[head[symbols] + rank] = j
            head += count
        if held[c]:
            j, symbols, rank, count = dealt(order[first[c] : end[c]], False)
            order[head[symbols] + rank] = j
            head += count
    tail = end.copy()
    for c in range(buckets - 1, -1, -1):
        done = end[c]
        while tail[c] < done:
            batch, done = order[tail[c] : done][::-1], tail[c]
            j, symbols, rank, count = dealt(batch, True)
            order[tail[symbols] - 1 - rank] = j
            tail -= count
        if head[c] > start[c]:
            j, symbols, rank, count = dealt(order[start[c] : head[c]][::-1], True)
            order[tail[symbols] - 1 - rank] = j
            tail -= count
    order[0] = n - 1  # the end of the text is smaller than everything
    return order


def _names(s: np.ndarray, leftmost: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings in text order: equal ones share one, larger ones have a larger one."""
    place = np.zeros(len(s), dtype=np.int64)
    place[leftmost] = np.arange(len(leftmost))
    stop = np.append(leftmost[1:], len(s) - 1)
    which = place[ranked]
    size = stop[which] - ranked
    differs = np.ones(len(ranked), dtype=bool)
    differs[1:] = size[1:] != size[:-1]
    left = np.flatnonzero(~differs)
    step = 0
    while len(left):
        unequal = s[ranked[left] + step] != s[ranked[left - 1] + step]
        differs[left[unequal]] = True
        left = left[~unequal & (step < size[left])]
        step += 1
    names = np.zeros(len(leftmost), dtype=np.int64)
    names[which] = np.cumsum(differs) - 1
    return names


def ordered(values: np.ndarray, bound: int) -> np.ndarray:
    """The stable order of values from 0 to below ``bound``; sorted in one word with their places, if they fit in it."""
    bits = len(values).bit_length()
    if bound > 1 << (63 - bits):
        return np.argsort(values, kind="stable")
    both = (values.astype(np.int64) << bits) | np.arange(len(values))
    both.sort()
    return both & ((1 << bits) - 1)


def _sorted_names(names: np.ndarray, covered: int, depth: int | None) -> np.ndarray:
    """The order of the suffixes of ``names``. A level of the recursion ranks runs of ``covered`` names by pairs."""
    if covered >= len(names) or (depth is not None and 2 * covered >= depth) or names.max() + 1 == len(names):
        return ordered(names, len(names))
    follow = np.zeros(len(names), dtype=np.int64)
    follow[:-covered] = names[covered:] + 1
    pairs = names * (len(names) + 1) + follow
    order = ordered(pairs, len(names) * (len(names) + 1))
    ranked = pairs[order]
    new = np.zeros(len(names), dtype=np.int64)
    new[order[1:]] = np.cumsum(ranked[1:] != ranked[:-1])
    return _sorted_names(new, 2 * covered, depth)


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The starts of all suffixes of bytes in order; with ``depth``, in the order of their first ``depth`` bytes."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    s = np.zeros(n + 1, dtype=np.int16)
    s[:-1] = text
    s[:-1] += 1
    small = _smaller(s)
    count = np.bincount(s, minlength=257)
    end = np.cumsum(count)
    start = end - count
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    is_leftmost = np.zeros(n + 1, dtype=bool)
    is_leftmost[leftmost] = True
    rough = _induce(s, small, leftmost, start, end)
    ranked = rough[is_leftmost[rough]]
    names = _names(s, leftmost, ranked)
    ranked = leftmost[_sorted_names(names, 1, depth)]
    return _induce(s, small, ranked, start, end)[1:]


_STRIDE = 64


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in ``order`` the bytes that its suffix shares with the one before, exact below ``most``.

    Prefixes are found in text order: where the predecessor of suffix i is the successor of that of i - 1, and those
    two begin alike, its prefix is one shorter. Only the other suffixes, and every ``_STRIDE``-th, are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    compared = np.ones(n, dtype=bool)
    compared[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (text[:-1] != text[before[:-1]])
    compared[::_STRIDE] = True
    at = np.flatnonzero(compared)
    words = -(-(most + _STRIDE) // 8)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = text
    wide = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        wide |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    shared = np.zeros(len(at), dtype=np.int64)
    left = np.flatnonzero(before[at] >= 0)
    for w in range(words):
        i, j = at[left] + 8 * w, before[at[left]] + 8 * w
        room = n - np.maximum(i, j)
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        x = np.where(room > 0, wide[i] ^ wide[j], np.uint64(1))
        same = np.zeros(len(left), dtype=np.int64)
        for k in range(1, 9):
            same += (x << np.uint64(64 - 8 * k)) == 0
        shared[left] += np.minimum(same, np.maximum(room, 0))
        left = left[(same == 8) & (room > 8)]
    lengths = np.zeros(n, dtype=np.int64)
    lengths[at] = shared
    root = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    lengths = np.maximum(lengths[root] - (np.arange(n) - root), 0)
    return lengths[order]
