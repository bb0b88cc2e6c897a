"""Removal of bytes that an earlier document has too, by suffix arrays over shards.

Every ``SPAN``-byte string is assigned to the least hash of its ``ANCHOR``-byte strings, its anchor, so that equal
strings have equal anchors wherever they stand. A stretch of strings with one anchor is a record of a few numbers.
Records are dealt by anchor, once; an anchor in one document only cannot repeat elsewhere and goes. So does a stretch
that agrees with no other document's on either side of the anchor: a string has ``SIDE`` bytes or more on one of them.
The larger a table, the more anchors are shared by chance; few of those also share a side. What is left
fetches its bytes, and each shard of whole anchors builds suffix arrays (``suffix_array``): suffixes that share a
prefix of at least ``SPAN`` bytes with their neighbours are the places of one string, and it stays in the least
document only.

An anchor that more than ``CROWD`` documents of a batch have in different stretches, such as a short line that a third
of all texts have, does not go to one task: that batch's records of it are dealt by stretch, and its own task is told.

Copies of a stretch are collapsed before its bytes are fetched: within an Arrow batch by comparing bytes, and among
the records of an anchor by a second hash, which with the anchor's own makes 96 bits or more; the least document
stands for all of them, and the others lose the stretch. So a group of copies reaches the shards once. An anchor with more
than ``HOT`` different stretches, such as a short common line amid other text, is dealt anew by each whole string,
settled within batches first. So are all stretches of an anchor dealt by stretch. One task holds at most ``CROWD``
documents per batch of an anchor, and a common string once per batch.

Defined cases: a null text is empty; texts shorter than ``SPAN`` and rows without ``doc_id`` are returned whole and
remove nothing elsewhere; rows that repeat a ``doc_id`` are judged each by its own text against the documents with a
lesser ``doc_id``, and remove nothing from each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm import flat
from millrace.llm.groups import changes, whole_groups
from millrace.llm.suffix_array import common_prefixes, ordered, suffix_array
from millrace.llm.tables import discard, written

SPAN = 50
ANCHOR = 18
HOT = 2000
#: Documents of a batch that may send different stretches of one anchor to one task.
CROWD = 200
#: Bytes of text whose stretches are compared with each other before they are dealt.
TOGETHER = 8 << 20
SHARD = 2 << 20
#: Bytes of strings that one suffix array is built of; its arrays take some hundred times as much.
SORTED = 1 << 19
#: Bytes of text that are hashed at once, and pairs of strings that are compared at once.
SCANNED, COMPARED = 1 << 18, 2000
#: Bytes of text whose records are grouped at once.
PART = 8 << 20

_WINDOW = SPAN - ANCHOR + 1
#: A string has at least as many bytes before its anchor or behind it.
SIDE = (SPAN - ANCHOR) // 2
#: Bits of an anchor's hash that are left out of records.
_LOW = np.uint64(16)
_TAG = np.uint64(0xA0761D6478BD642F)


def _slice_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of strings with one anchor: text, first string, number of strings, hashes of the anchor and its sides."""
    n = len(data)
    if n < SPAN:
        return _no_stretches()
    grams = np.arange(n - ANCHOR + 1)
    power, inverse = flat.powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(flat._BYTES[data] * power[:n], out=sums[1:])
    keys = flat.mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: len(grams)])
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = ((keys >> bits) << bits) | grams.astype(np.uint64)
    size, least = 1, packed
    while 2 * size <= _WINDOW:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = _WINDOW - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    place = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)  # the anchor of the string at each byte
    text = flat.owners(offsets)[: len(place)]
    valid = np.arange(len(place)) + SPAN <= offsets[text + 1]
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    heads = np.flatnonzero(new)
    ends = np.flatnonzero(valid & ~np.append(valid[1:] & ~new[1:], False))
    place = place[heads]

    def side(low: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """A byte of hash of the ``SIDE`` bytes at ``low``; 0 if the stretch has fewer on this side of its anchor."""
        low = np.where(inside, low, 0)
        hashed = flat.mix((sums[low + SIDE] - sums[low]) * inverse[low])
        return np.where(inside, hashed % np.uint64(255) + np.uint64(1), np.uint64(0)).astype(np.uint8)

    before = side(place - SIDE, place - SIDE >= heads)
    behind = side(place + ANCHOR, place + ANCHOR + SIDE <= ends + SPAN)
    return text[heads], heads, ends - heads + 1, keys[place], before, behind


def _no_stretches() -> tuple[np.ndarray, ...]:
    return tuple(np.zeros(0, kind) for kind in (*[np.int64] * 3, np.uint64, np.uint8, np.uint8))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The stretches of all texts, a bounded slice of bytes at a time; slices overlap by less than a string."""
    found = []
    n = int(offsets[-1])
    for low in range(0, n, SCANNED):
        high = min(n, low + SCANNED + SPAN - 1)
        inner = np.clip(offsets, low, high) - low
        text, start, *rest = _slice_anchors(data[low:high], inner)
        found.append((text, start + low, *rest))
    if not found:
        return _no_stretches()
    return tuple(np.concatenate(c) for c in zip(*found))


def _string_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of byte strings that may overlap; starts ascend."""
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(starts, base + SCANNED)))
        top = int((starts[at:stop] + sizes[at:stop]).max())
        part = data[base:top]
        power, inverse = flat.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(flat._BYTES[part] * power[: len(part)], out=sums[1:])
        s = starts[at:stop] - base
        out[at:stop] = (sums[s + sizes[at:stop]] - sums[s]) * inverse[s]
        at = stop
    return flat.mix(out + sizes.astype(np.uint64))


def _equal(data: np.ndarray, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which strings of bytes at ``x`` and ``y`` are equal."""
    out = np.ones(len(x), dtype=bool)
    for at in range(0, len(x), COMPARED):
        part = slice(at, at + COMPARED)
        size = sizes[part]
        step = np.arange(int(size.max()))
        inside = step < size[:, None]
        reach = np.minimum(step, size[:, None] - 1)
        out[part] = ((data[x[part, None] + reach] == data[y[part, None] + reach]) | ~inside).all(axis=1)
    return out


def _several(values: np.ndarray, most: int = 1) -> np.ndarray:
    """Which values occur more than ``most`` times. Sorting by one column is fast; what is left is sorted by all."""
    order = np.argsort(values)
    ranked = values[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    count = np.diff(np.append(heads, len(ranked)))
    out = np.zeros(len(values), dtype=bool)
    out[order] = np.repeat(count > most, count)
    return out


def _settled(data, key, code, start, size, doc) -> np.ndarray:
    """Which strings also stand, with the same key, in a lesser document of this batch."""
    several = np.flatnonzero(_several(code))
    order = several[np.lexsort(tuple(x[several] for x in (doc, size, code, key)))]
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for column in (key, code, size):  # one at a time, for the sake of memory
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    heads = np.flatnonzero(new)
    first = np.repeat(order[heads], np.diff(np.append(heads, len(order))))
    later = doc[order] > doc[first]
    order, first = order[later], first[later]
    out = np.zeros(len(code), dtype=bool)
    if len(order):
        out[order[_equal(data, start[order], start[first], size[order])]] = True
    return out


def _merged(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each text with those that touch or overlap made one; sorted by text and begin, ends ascend too."""
    if not len(text):
        return text, begin, end
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (begin[1:] > end[:-1])
    heads = np.flatnonzero(new)
    return text[heads], begin[heads], end[np.append(heads[1:], len(text)) - 1]


#: Rows of records: stretches dealt by anchor or by stretch, anchors of the latter, and spans that are settled.
_BY_ANCHOR, _BY_STRETCH, _CROWDED, _DONE = 0, 1, 2, 3

RECORDS = "part int, form byte, keys binary, codes binary, sides binary, docs binary, starts binary, sizes binary"


def _packed(values: np.ndarray) -> np.ndarray:
    """The upper six bytes of 64-bit hashes, a row each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]


def _unpacked(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, 2:] = data.reshape(-1, 6)
    return wide.view("<u8").ravel()


def _bytes(values: np.ndarray) -> np.ndarray:
    """Numbers as rows of bytes, the lowest first, as many as the largest takes."""
    bits = int(values.max(initial=0)).bit_length() if values.min(initial=0) >= 0 else 64
    return values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, : max(1, -(-bits // 8))]


def _planes(each: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of bytes as blocks that begin at ``bounds``, the last of which is the end.

    A block has one plane per byte, so that high bytes, mostly zero, take no room where blocks are compressed. The more
    parts there are, the fewer rows a block has: nothing may be done block by block.
    """
    width, count = each.shape[1], np.diff(bounds)
    at, step = np.arange(len(each)) + np.repeat((width - 1) * bounds[:-1], count), np.repeat(count, count)
    out = np.empty(each.size, dtype=np.uint8)
    for k in range(width):
        out[at + k * step] = each[:, k]
    return out


def _rows(data: np.ndarray, offsets: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
    """The rows of ``count`` each of the blocks that begin at ``offsets``; those of fewer bytes than ``most`` end in zeros."""
    width = np.diff(offsets) // np.maximum(count, 1)
    at = np.arange(count.sum()) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
    step, wide = np.repeat(count, count), np.repeat(width, count)
    out = np.zeros((len(at), most), dtype=np.uint8)
    for k in range(int(width.max(initial=0))):
        has = wide > k
        if has.all():
            out[:, k] = data[at + k * step]
        else:
            out[has, k] = data[at[has] + k * step[has]]
    return out


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes from those of all, and where each begins (one more)."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _crowded(key: np.ndarray, doc: np.ndarray, most: int) -> np.ndarray:
    """Which records have an anchor that more than ``most`` documents have."""
    several = np.flatnonzero(_several(key, most))
    order = several[np.lexsort((doc[several], key[several]))]
    k, d = key[order], doc[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    other = new.copy()
    other[1:] |= d[1:] != d[:-1]
    heads = np.flatnonzero(new)
    out = np.zeros(len(key), dtype=bool)
    if len(heads):
        out[order] = np.repeat(np.add.reduceat(other.astype(np.int64), heads) > most, np.diff(np.append(heads, len(k))))
    return out


def _dealt(parts: int, crowd: int):
    """Records in arrays by the part they belong to, and spans that a lesser document of the batch settles."""

    def blocks(form, part, key, code, sides, doc, start, size) -> pa.RecordBatch:
        order = ordered(part, parts)
        part = part[order]
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        bounds = np.append(heads, len(part))
        each = [np.ascontiguousarray(key[order]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6], sides[order]]
        each += [_bytes(c[order]) for c in (doc, start, size)]
        arrays = [_binaries(_planes(rows, bounds), rows.shape[1] * bounds) for rows in each]
        arrays.insert(1, _binaries(_packed(code[order]).ravel(), 6 * bounds))
        heading = [pa.array(part[heads].astype(np.int32)), pa.array(np.full(len(heads), form, dtype=np.int8))]
        return pa.RecordBatch.from_arrays(heading + arrays, ["part", "form", "keys", "codes", "sides", "docs", "starts", "sizes"])

    def dealt_to(hashes: np.ndarray) -> np.ndarray:
        return (flat.mix(hashes) % np.uint64(parts)).astype(np.int64)

    def by_anchor(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of anchors, and what is left of the upper 48 bits of their hashes where the part is known."""
        part = (key >> _LOW) % np.uint64(parts)
        return part.astype(np.int64), (key >> _LOW) // np.uint64(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in flat.pieces(batch, "text", TOGETHER):
                data, offsets = flat.texts(piece.column("text"))
                ids, base = (piece.column(c).to_numpy() for c in ("doc_id", "base"))
                text, start, count, key, before, behind = anchors(data, offsets)
                sides = np.stack([before, behind], axis=1)
                place = base - offsets[:-1]  # what makes a place in the data one in its document
                size = count + SPAN - 1
                code = _string_hashes(data, start, size)
                gone = _settled(data, key, code, start, size, ids[text])
                rest = ~gone
                doc, begin = ids[text], start + place[text]
                crowded = np.zeros(len(key), dtype=bool)
                crowded[rest] = _crowded(key[rest], doc[rest], crowd)
                plain = rest & ~crowded
                yield blocks(_BY_ANCHOR, *by_anchor(key[plain]), *(x[plain] for x in (code, sides, doc, begin, size)))
                if crowded.any():
                    own = dealt_to(flat.mix(key[crowded]) ^ code[crowded])
                    yield blocks(_BY_STRETCH, own, *(x[crowded] for x in (key >> _LOW, code, sides, doc, begin, size)))
                    told = np.unique(key[crowded])
                    zeros, none = np.zeros(len(told), dtype=np.int64), np.zeros((len(told), 2), dtype=np.uint8)
                    yield blocks(_CROWDED, *by_anchor(told), zeros.view(np.uint64), none, zeros, zeros, zeros)
                owner, first, last = _merged(text[gone], start[gone], (start + size)[gone])
                none = np.zeros(len(owner), dtype=np.uint64)
                part, sides = dealt_to(ids[owner].astype(np.uint64)), np.zeros((len(owner), 2), dtype=np.uint8)
                yield blocks(_DONE, part, none, none, sides, ids[owner], first + place[owner], last - first)

    return run


FOUND = "doc long, key long, start long, size int, kind byte"
_STRETCH, _HOT, _SETTLED = 0, 1, 2


def _found(doc, key, start, size, kind) -> pa.RecordBatch:
    columns = [doc.astype(np.int64), key.view(np.int64), start.astype(np.int64), size.astype(np.int32), kind.astype(np.int8)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "key", "start", "size", "kind"])


def _shared(hot: int, parts: int):
    """Drops anchors and sides of one document, settles copies of a stretch, and keeps the stretches that differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part"]):
            heads = changes(table, ["part"])
            for lo, hi in zip(heads, [*heads[1:], table.num_rows]):
                part = table.slice(lo, hi - lo)
                done, told, plain, apart = (part.filter(pc.equal(part.column("form"), form))
                                            for form in (_DONE, _CROWDED, _BY_ANCHOR, _BY_STRETCH))
                if done.num_rows:
                    doc, start, size = _arrays(done)
                    yield _found(doc, np.zeros(len(doc), np.uint64), start, size, np.full(len(doc), _SETTLED))
                own = np.uint64(part.column("part")[0].as_py())
                crowded = (_keys(told) * np.uint64(parts) + own) << _LOW
                for rows, everywhere in ((plain, False), (apart, True)):
                    key = (_keys(rows) if everywhere else _keys(rows) * np.uint64(parts) + own) << _LOW
                    if len(key):
                        code = _unpacked(flat.texts(rows.column("codes"))[0])
                        yield of_anchors(key, code, _column(rows, "sides", 2), *_arrays(rows), crowded, everywhere)

    def of_anchors(key, code, sides, doc, start, size, crowded, everywhere) -> pa.RecordBatch:
        """Anchors in ``crowded``, or with ``everywhere`` all, have further stretches in other parts."""
        if not everywhere:
            several = _several(key)
            if len(crowded):
                several |= np.isin(key, crowded)
            key, code, sides, doc, start, size = (x[several] for x in (key, code, sides, doc, start, size))
        order = np.lexsort((doc, size, code, key))
        key, code, sides, doc, start, size = (x[order] for x in (key, code, sides, doc, start, size))
        new_key = _changed(key)
        new = new_key | _changed(code) | _changed(size)
        at = np.flatnonzero(new_key)
        if not len(at):
            return _found(doc, key, start, size, doc)
        count = np.diff(np.append(at, len(key)))
        beyond = np.ones(len(key), dtype=bool) if everywhere else np.repeat(np.isin(key[at], crowded), count)
        shared = np.repeat(np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at), count)
        different = np.repeat(np.add.reduceat(new.astype(np.int64), at), count)
        copy = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        # the least document of an anchor with one stretch has nothing to be compared with
        compared = shared & (different > 1)
        left = np.flatnonzero(compared)
        compared[left] = agreeing(key[left], np.cumsum(new)[left], sides[left], doc[left])
        fetched = np.repeat(np.add.reduceat((new & compared).astype(np.int64), at), count)
        kind = np.where(copy, _SETTLED, np.where(beyond | (fetched > hot), _HOT, _STRETCH))
        keep = beyond | (shared & copy) | compared
        return _found(doc[keep], key[keep], start[keep], size[keep], kind[keep])

    def agreeing(key, stretch, sides, doc) -> np.ndarray:
        """Which records have a side in common with another stretch of their anchor, which may be of another document."""
        out = np.zeros(len(key), dtype=bool)
        for side in (sides[:, 0], sides[:, 1]):
            order = np.lexsort((stretch, side, key))
            order = order[side[order] > 0]
            if not len(order):
                continue
            new = _changed(key[order]) | _changed(side[order])
            at = np.flatnonzero(new)
            lots = np.add.reduceat((new | _changed(stretch[order])).astype(np.int64), at) > 1
            lots &= np.minimum.reduceat(doc[order], at) < np.maximum.reduceat(doc[order], at)
            out[order] |= np.repeat(lots, np.diff(np.append(at, len(order))))
        return out

    return run


def _changed(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before, or there is none."""
    return np.append(True, values[1:] != values[:-1])[: len(values)]


def _column(table: pa.Table, name: str, most: int = 8) -> np.ndarray:
    """The bytes of a column of blocks, a row for each record."""
    return _rows(*flat.texts(table.column(name)), np.diff(flat.texts(table.column("codes"))[1]) // 6, most)


def _keys(table: pa.Table) -> np.ndarray:
    return _column(table, "keys").view("<u8").ravel()


def _arrays(table: pa.Table) -> tuple[np.ndarray, ...]:
    return tuple(_column(table, name).view("<i8").ravel() for name in ("docs", "starts", "sizes"))


STRINGS = "key long, doc long, start long, bytes binary, size long"


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of shared stretches; stretches of hot anchors as single strings, settled within the batch."""
    for batch in batches:
        for part in flat.pieces(batch, "text", TOGETHER):
            data, offsets = flat.texts(part.column("text"))
            held = part.column("held")
            rows = held.flatten()
            owner = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
            key, start, size, kind = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            ids, base = (part.column(c).to_numpy() for c in ("doc_id", "base"))
            own = (start >= base[owner]) & (start < base[owner] + np.diff(offsets)[owner])  # of this text of the document
            owner, key, start, size, kind = (x[own] for x in (owner, key, start, size, kind))
            place = base - offsets[:-1]
            start, size = start - place[owner], size.astype(np.int64)
            plain, hot, done = kind == _STRETCH, kind == _HOT, kind == _SETTLED
            out = [(key[plain], owner[plain], start[plain], size[plain])]
            if done.any():
                order = np.lexsort((start[done] + size[done], start[done]))
                whose, begin, end = owner[done][order], start[done][order], (start + size)[done][order]
                whose, begin, end = _merged(whose, begin, np.maximum.accumulate(end))
                yield _string_batch(ids[whose], ids[whose], begin + place[whose], [end - begin], True)
            if hot.any():
                each = size[hot] - SPAN + 1
                inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                single, whose = np.repeat(start[hot], each) + inner, np.repeat(owner[hot], each)
                order = np.argsort(single, kind="stable")
                single, whose = single[order], whose[order]
                size = np.full(len(single), SPAN, dtype=np.int64)
                code = _string_hashes(data, single, size)
                gone = _settled(data, code, code, single, size, ids[whose])
                rest = ~gone
                out.append(((code[rest] ^ _TAG).view(np.int64), whose[rest], single[rest], size[rest]))
                mine, begin, end = _merged(whose[gone], single[gone], single[gone] + SPAN)
                if len(mine):
                    yield _string_batch(ids[mine], ids[mine], begin + place[mine], [end - begin], True)
            for key, whose, begin, size in out:
                if len(key):
                    texts = [data[b : b + z].tobytes() for b, z in zip(begin.tolist(), size.tolist())]
                    yield _string_batch(key, ids[whose], begin + place[whose], texts, False)


def _string_batch(key, doc, start, texts, settled) -> pa.RecordBatch:
    """Strings to be compared; or spans that are settled, whose bytes are of no interest, with their sizes."""
    size = texts[0] if settled else np.zeros(len(key), dtype=np.int64)
    held = pa.nulls(len(key), pa.binary()) if settled else pa.array(texts, pa.binary())
    columns = [pa.array(key), pa.array(doc), pa.array(start), held, pa.array(size)]
    return pa.RecordBatch.from_arrays(columns, ["key", "doc", "start", "bytes", "size"])


def _sortable(table: pa.Table) -> Iterator[pa.Table]:
    """Slices of a table sorted by key that part no key and have at most ``SORTED`` bytes of strings each, or one key."""
    _, offsets = flat.texts(table.column("bytes"))
    heads = np.append(changes(table, ["key"]), table.num_rows)
    place, at = offsets[heads], 0
    while at + 1 < len(heads):
        end = max(at + 1, int(np.searchsorted(place, place[at] + SORTED, "right")) - 1)
        yield table.slice(heads[at], heads[end] - heads[at])
        at = end


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the strings of a shard that a lesser document of the shard has too."""
    for table in whole_groups(batches, ["key"], SHARD):
        settled = table.column("size").to_numpy() > 0
        done = table.filter(pa.array(settled))
        if done.num_rows:
            yield _spans(*(done.column(c).to_numpy() for c in ("doc", "start", "size")))
        for part in _sortable(table.filter(pa.array(~settled))):
            yield _compared(part)


def _compared(table: pa.Table) -> pa.RecordBatch:
    """Spans of strings, whole keys of them, that a lesser document among them has too."""
    data, offsets = flat.texts(table.column("bytes"))
    doc, start = table.column("doc").to_numpy(), table.column("start").to_numpy()
    order = suffix_array(data, SPAN)
    run = np.cumsum(common_prefixes(data, order, SPAN) < SPAN) - 1
    text = flat.owners(offsets)
    whole = np.arange(len(data)) + SPAN <= offsets[text + 1]  # the string does not run into the next one
    least = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    at = order[whole[order]]
    np.minimum.at(least, run[whole[order]], doc[text[at]])
    gone = at[doc[text[at]] > least[run[whole[order]]]]
    edges = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edges, gone, 1)
    np.add.at(edges, gone + SPAN, -1)
    covered = np.cumsum(edges[:-1]) > 0
    begins = covered.copy()
    begins[1:] &= ~covered[:-1] | (text[1:] != text[:-1])
    ends = covered.copy()
    ends[:-1] &= ~covered[1:] | (text[1:] != text[:-1])
    b, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return _spans(doc[text[b]], start[text[b]] + b - offsets[text[b]], e - b)


def _spans(doc: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc": doc, "begin": begin, "size": size.astype(np.int64)})


_CUT = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut(text: pa.Scalar, spans: pa.Scalar, base: int, keep_text: bool) -> tuple:
    """What is removed from one text, which begins at ``base`` in its document, and what is left."""
    raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
    kept, at, removed, n = [], 0, 0, 0
    if spans.is_valid:
        begin, size = (spans.values.field(k).to_numpy() for k in range(2))
        own = (begin >= base) & (begin < base + len(raw))
        begin, size = begin[own] - base, size[own]
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(begin[order] + size[order])
        for _, b, e in zip(*_merged(np.zeros(len(begin), np.int64), begin, end)):
            kept.append(raw[at:b])
            removed, n, at = removed + int(e - b), n + 1, int(e)
    rest = b"".join(kept + [raw[at:]])
    found = (len(raw), removed, n, hashlib.sha256(rest).hexdigest())
    # a span may begin or end within a character; what is left of that one goes too
    return found + (rest.decode("utf-8", "ignore"),) if keep_text else found


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc``, ``begin``, ``size`` of bytes of ``_id`` and ``_text`` to be removed; spans may touch and overlap.

    Several texts of one ``_id`` are told by ``_base``, the place at which each begins in its document.
    """
    total = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    parts = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART))
    named = docs.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_base").alias("base"))
    dealt = named.mapInArrow(_dealt(parts, CROWD), RECORDS).repartition("part").sortWithinPartitions("part")
    held = dealt.mapInArrow(_shared(HOT, parts), FOUND).groupBy(F.col("doc").alias("_of")).agg(
        F.collect_list(F.struct("key", "start", "size", "kind")).alias("held")
    )
    fetched = docs.join(held, F.col("_id") == F.col("_of"))
    wanted = fetched.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_base").alias("base"), "held")
    strings = wanted.mapInArrow(_strings, STRINGS).repartition("key").sortWithinPartitions("key")
    return strings.mapInArrow(_repeats, "doc long, begin long, size long")


#: Bits of a place within a text; what is above tells the text.
PLACE = 31


def _based(rows: DataFrame, again: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the ``_base`` of their text, and each text of each document once; for documents with several rows.

    The different texts of the ids in ``again`` are numbered over all, so that no id has to fit one task.
    """
    one = F.col("_id") == F.col("_twice")
    texts = rows.select("_id", "_text").join(again, one, "left_semi").distinct()
    texts = written(texts.withColumn("_at", F.monotonically_increasing_id()), "texts")
    sizes = texts.groupBy(F.shiftright("_at", 33).alias("part")).count().collect()  # one row per task
    before, total = {}, 0
    for part, n in sorted(map(tuple, sizes)):
        before[part], total = total, total + n
    if total >= 1 << (63 - PLACE):
        raise ValueError(f"{total} texts of repeated ids, at most {1 << (63 - PLACE)} can be told apart")
    spark = rows.sparkSession
    starts = spark.createDataFrame(sorted(before.items()), "_part long, _before long")
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    based = texts.join(starts, F.shiftright("_at", 33) == F.col("_part")).select(
        F.col("_id").alias("_one"), F.col("_text").alias("_its"), F.shiftleft(number, PLACE).alias("_base")
    )
    single = rows.join(again, one, "left_anti").withColumn("_base", F.lit(0).cast("long"))
    same = (F.col("_id") == F.col("_one")) & F.col("_text").eqNullSafe(F.col("_its"))
    several = rows.join(again, one, "left_semi").join(based, same).select(single.columns)
    sources = single.select("_id", "_text", "_base").union(based)
    return single.union(several), sources


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), keep_text: bool = False) -> DataFrame:
    """The columns ``keep``, the bytes removed and the hash of the rest; with ``keep_text`` also ``kept_text``."""
    ids = F.col("doc_id").cast("long").alias("_id")
    carried = [name for name in keep if name != "doc_id"]
    # One shuffle of the texts serves both the fetching of strings and the cutting, if nothing else is carried.
    rows = docs.filter(F.col("doc_id").isNotNull()).select(ids, F.col("text").alias("_text"), *carried)
    again = written(rows.groupBy(F.col("_id").alias("_twice")).count().filter("count > 1").select("_twice"), "again")
    if again.isEmpty():
        discard(again)
        rows = rows.withColumn("_base", F.lit(0).cast("long"))
        sources = rows.select("_id", "_text", "_base")
    else:
        rows, sources = _based(rows, again)
    spans = repeated_spans(sources)
    by_doc = spans.groupBy(F.col("doc").alias("_of")).agg(F.collect_list(F.struct("begin", "size")).alias("_spans"))
    joined = rows.join(by_doc, F.col("_id") == F.col("_of"), "left")
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        ids, F.col("text").alias("_text"), *carried, F.lit(0).cast("long").alias("_base"),
        F.lit(None).cast("array<struct<begin:long,size:long>>").alias("_spans"),
    )
    added = StructType.fromDDL(_CUT + ", kept_text string" * keep_text)
    kinds = [pa.int64()] * 3 + [pa.string()] * (len(added) - 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.pieces(batch, "_text", TOGETHER):
                base = part.column("_base").to_pylist()
                cut = [_cut(t, s, b, keep_text) for t, s, b in zip(part.column("_text"), part.column("_spans"), base)]
                found = [pa.array(c, kind) for c, kind in zip(zip(*cut), kinds)]
                kept = [part.column("_id" if name == "doc_id" else name) for name in keep]
                yield pa.RecordBatch.from_arrays([*kept, *found], [*keep, *added.names])

    kept = docs.withColumn("doc_id", F.col("doc_id").cast("long")).select(*keep)
    schema = StructType([*kept.schema.fields, *added.fields])
    return joined.select(nameless.columns).union(nameless).mapInArrow(run, schema)
