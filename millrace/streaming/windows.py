"""Counts over event-time windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.clock import ceil_to, from_micros, micros, to_micros
from millrace.operators.metrics import hourly_branch_counts


def streaming_branch_counts(df: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Readings per window, device and branch; a window is final, and its state gone, once the watermark
    has passed it. Readings later than ``delay`` are not counted."""
    return hourly_branch_counts(df.withWatermark("ts", delay), window)


def _per_bucket(key: str):
    """Rows of each key and bucket in an Arrow batch: all of them, those at the bucket's very end, the latest time."""
    keys = [key, "until"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).group_by(keys, use_threads=False)
            counted = rows.aggregate([("n", "sum"), ("at_end", "sum"), ("us", "max")])
            counted = counted.select([*keys, "n_sum", "at_end_sum", "us_max"]).rename_columns([*keys, "n", "at_end", "us"])
            yield from counted.to_batches()

    return run


def streaming_error_counts(
    df: DataFrame,
    length: str = "1 hour",
    every: str = "1 minute",
    delay: str = "10 minutes",
    key: str = "DeviceId",
    name: str = "error_count",
) -> DataFrame:
    """Rows per device in the trailing ``length`` at every instant, a multiple of ``every``, that the watermark passes:
    ``as_of``, the device and its count, as :func:`millrace.operators.metrics.error_count_per_device` has it, both ends
    of the window included. A device without rows in the window has no count.

    State is a ring of buckets per device, one for each ``every`` of the window and of ``delay``; buckets expire by event
    time. A timer goes on counting while no row comes, until the ring is empty and the device is forgotten. Rows of a
    bucket are counted within their task before they are shuffled, so a device with a third of all rows sends as many
    rows as there are tasks and ticks. Rows later than ``delay`` are dropped and counted in the progress; rows without a
    time or a device are not counted.
    """
    size, span = micros(every), micros(length)
    if span % size:
        raise ValueError(f"{length} is not a multiple of {every}")

    def advance(device: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [], [], None)
        ring = {until: [n, at_end] for until, n, at_end in zip(*held[:3])}
        upcoming = held[3]
        for frame in frames:
            for until, n, at_end in zip(frame["until"].tolist(), frame["n"].tolist(), frame["at_end"].tolist()):
                both = ring.setdefault(until, [0, 0])
                both[0] += n
                both[1] += at_end
        if not ring:
            return
        ends = np.array(sorted(ring), dtype=np.int64)
        counts, edges = np.array([ring[e] for e in ends.tolist()], dtype=np.int64).T
        upcoming = int(ends[0]) if upcoming is None else upcoming
        passed = state.getCurrentWatermarkMs() * 1000 // size * size
        # behind the last bucket that counts there is nothing to count
        grid = np.arange(upcoming, min(passed, int(ends[-1]) + span) + 1, size)
        if len(grid):
            total = np.concatenate([[0], np.cumsum(counts)])
            low = np.searchsorted(ends, grid - span, "right")
            found = total[np.searchsorted(ends, grid, "right")] - total[low]
            first = np.maximum(low - 1, 0)
            found += np.where((low > 0) & (ends[first] == grid - span), edges[first], 0)
            some = found > 0
            yield pd.DataFrame({"as_of": pd.to_datetime(grid[some], unit="us"), key: device[0], name: found[some]})
            upcoming = int(grid[-1]) + size
        keep = ends >= upcoming - span
        if not keep.any():
            state.remove()
            return
        if int(ends[keep][0]) > upcoming:
            upcoming = int(ends[keep][0])
        state.update((ends[keep].tolist(), counts[keep].tolist(), edges[keep].tolist(), upcoming))
        state.setTimeoutTimestamp(max(upcoming // 1000 - 1, state.getCurrentWatermarkMs()))

    us = to_micros(F.col("ts"))
    until = ceil_to(us, size)
    rows = df.filter(F.col("ts").isNotNull() & F.col(key).isNotNull()).select(
        key, until.alias("until"), us.alias("us"), F.lit(1).cast("long").alias("n"), (us == until).cast("long").alias("at_end")
    )
    kind = rows.schema[key].dataType.simpleString()
    counted = rows.mapInArrow(_per_bucket(key), f"`{key}` {kind}, until long, n long, at_end long, us long")
    dated = counted.withColumn("seen", from_micros(F.col("us"))).withWatermark("seen", delay)
    return dated.groupBy(key).applyInPandasWithState(
        advance,
        f"as_of timestamp, `{key}` {kind}, `{name}` long",
        "ends array<long>, counts array<long>, edges array<long>, next long",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
