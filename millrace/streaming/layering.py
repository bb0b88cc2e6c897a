"""The continuous job: messages in, four layers out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedup import dedup_bounded, dedup_exact, melt_copies
from millrace.plans.readings import complete_readings, labelled
from millrace.schema import BRANCHES, DEFAULT_RANGES, PARTITIONS, TRIGGER, Ranges
from millrace.session import stateful_settings
from millrace.sinks.committed import write_committed
from millrace.sinks.layers import write_layer


def distinct(rows: DataFrame, dedup: str = "exact", delay: str = "1 hour", melt: bool = True) -> DataFrame:
    """Distinct readings of a stream; copies that arrive together melt before they are shuffled.

    ``bounded`` forgets a reading after ``delay``, so ``delay`` has to cover the disorder of arrival; readings that
    come later are dropped and counted in the progress. Readings without event time are remembered for ever.
    """
    if dedup not in ("exact", "bounded"):
        raise ValueError(f"dedup must be exact or bounded, not {dedup}")
    rows = melt_copies(rows) if melt and rows.isStreaming else rows
    if dedup == "exact" or not rows.isStreaming:
        return dedup_exact(rows)
    # What has no time has no place on the clock by which it could be forgotten.
    dated, undated = rows.filter("ts IS NOT NULL"), rows.filter("ts IS NULL")
    return dedup_bounded(dated, delay=delay).union(dedup_exact(undated))


def start_layers(
    messages: DataFrame,
    root: str,
    ranges: Ranges = DEFAULT_RANGES,
    dedup: str = "exact",
    delay: str = "1 hour",
    melt: bool = True,
    separate: bool = False,
    trigger: str | None = TRIGGER,
    fmt: str = "json",
    files_per_hour: int = 1,
    checkpoint: str | None = None,
    state_partitions: int | None = None,
    name: str = "layers",
    committed: bool = False,
    **sink,
) -> list[StreamingQuery]:
    """Start the layered write of a message stream and return its query, as a list.

    One query does it all: readings are read and deduplicated once, with one state, and written once, below
    ``branch=<layer>``; all branches together are the raw layer. With ``committed`` batches have folders of their own
    and an index of their hours (:mod:`millrace.sinks.committed`), which lets a scan open the folders of its hours
    only. ``separate`` is that with a directory for each layer and one for the raw layer, which holds all readings
    once more; ``sink`` are further arguments for :func:`millrace.sinks.committed.write_committed`.
    """
    spark = messages.sparkSession
    with stateful_settings(spark, state_partitions):
        rows = complete_readings(messages)
        one = labelled(distinct(rows, dedup, delay, melt), ranges)
        if separate:
            layers = {"raw-data": None, **{layer: F.col("branch") == layer for layer in BRANCHES}}
            parts = PARTITIONS
        else:
            layers, parts = {"": None}, ("branch", *PARTITIONS)
        if separate or committed:
            query = write_committed(one, root, layers, name, trigger, fmt, parts, checkpoint, files_per_hour, **sink)
        else:
            query = write_layer(one, root, name, trigger, fmt, parts, checkpoint, files_per_hour)
        return [query]
