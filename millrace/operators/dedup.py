"""One row per distinct reading."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.schema import DEDUP_KEYS


def dedup_exact(
    df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key for ever.

    In batch the earliest row by ``order`` stays, so the result does not depend on row placement; each map
    task passes on at most one row per key, so a reading that was copied a billion times is no hot group.
    On a stream the row that arrives first stays.
    """
    if df.isStreaming:
        return df.dropDuplicates(list(keys))
    if order is None:
        order = [c for c in ("ts", "time", "collected_at") if c in df.columns]
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def dedup_bounded(
    df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, ts: str = "ts", delay: str = "1 hour"
) -> DataFrame:
    """On a stream, forget a key once the watermark has passed its first event time by ``delay``.

    State then grows with the readings of one delay, not with all readings ever seen. A batch has no
    state to bound, so all copies fall to :func:`dedup_exact`.
    """
    if not df.isStreaming:
        return dedup_exact(df, keys)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def melt_copies(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Drop copies within each Arrow batch of a task, ahead of a streaming deduplication.

    A stream has no map-side step of its own for this: all copies of a reading would travel to the one
    task that holds its key. Which copies are left does not matter, the state behind drops them.
    """

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).append_column("_row", pa.array(np.arange(batch.num_rows)))
            kept = rows.group_by(list(keys), use_threads=False).aggregate([("_row", "min")])
            yield batch.take(kept["_row_min"].combine_chunks())

    return df.mapInArrow(firsts, df.schema)
