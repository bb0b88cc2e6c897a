"""Whole groups of rows from a sorted partition, a bounded amount at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm.flat import release


def changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The row at which each group begins, in a table sorted by ``keys`` (integers without nulls)."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 8 << 20) -> Iterator[pa.Table]:
    """Tables of about ``most`` bytes that do not part a group; the partition must be sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    size, limit = 0, most
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(changes(table, keys)[-1])
        if cut:
            yield table.slice(0, cut)
            release()
            held, limit = table.slice(cut).to_batches(), most
            size = sum(b.nbytes for b in held)
        else:
            limit = 2 * size
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
        release()
