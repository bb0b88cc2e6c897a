"""Layers of a stream written batch by batch, each valid as a whole or not at all, with an index of hours.

A batch has a folder of its own in every layer, ``<root>/<layer>/batch=<name>/year=.../hour=.../``. Behind its layers
it writes its entries of the index, one row per layer and hour; then one file, ``<root>/_committed``, is swapped, which
names the batches that are valid. A batch that fails anywhere before is written over when it is repeated; one that
fails behind it is known to be valid and not written again. So each row is in each of its layers once, whenever the job
stops.

Readers take the hours they are asked for from the index: no folder of another hour is listed. Every ``MERGE`` batches
their entries are merged with the earlier ones into one table, sorted by hour, so that a scan of two hours reads few row
groups of it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.schema import PARTITIONS, TRIGGER
from millrace.sinks.layers import spread
from millrace.sinks.pointer import drop, pointed, swap

#: Batches whose index entries are merged into the table of earlier ones.
MERGE = 64

INDEX = "layer string, year int, month int, day int, hour int, batch string"

#: Told where a batch has got to, for tests of failures.
Probe = Callable[[str, int], None]


def committed(spark: SparkSession, root: str) -> dict | None:
    """The valid batches of a root: the last number of each writer, the merged index and the entries that are not in it
    yet; None if the root is not written this way."""
    text = pointed(spark, f"{root}/_committed")
    return None if text is None else json.loads(text)


def batch_index(spark: SparkSession, root: str, state: dict) -> DataFrame:
    """The index of all valid batches: ``layer``, the hour and ``batch``."""
    names = ([state["merged"]] if state["merged"] else []) + state["loose"]
    if not names:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(*[f"{root}/_index/{name}" for name in names])


def valid_batches(state: dict) -> Column:
    """Whether the column ``batch`` names a valid batch."""
    writer, number = F.split_part("batch", F.lit("-"), F.lit(1)), F.split_part("batch", F.lit("-"), F.lit(2)).cast("long")
    out = F.lit(False)
    for name, last in state["last"].items():
        out = out | ((writer == name) & (number <= last))
    return out


def _merge(spark: SparkSession, root: str, state: dict, name: str) -> dict:
    """The index as one table more; what it replaces goes at the merge after."""
    merged = f"merged-{name}"
    rows = batch_index(spark, root, state)
    rows.repartitionByRange(*PARTITIONS, "layer").sortWithinPartitions(*PARTITIONS, "layer").write.mode("overwrite").parquet(
        f"{root}/_index/{merged}"
    )
    old = state["loose"] + ([state["merged"]] if state["merged"] else [])
    return {**state, "merged": merged, "loose": [], "old": old}


def batch_writer(
    spark: SparkSession,
    root: str,
    layers: Mapping[str, Column | None],
    writer: str,
    fmt: str,
    partitions: Sequence[str],
    files_per_hour: int | None,
    merge: int = MERGE,
    probe: Probe = lambda stage, batch: None,
) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls. ``layers`` has the rows of each layer, by a condition, None for all."""

    def write(batch: DataFrame, number: int) -> None:
        state = committed(spark, root)
        if state["last"].get(writer, -1) >= number:
            # Valid already; the batch is gone through once more for what the query remembers.
            batch.write.format("noop").mode("overwrite").save()
            return
        name = f"{writer}-{number}"
        held = spread(batch, partitions, files_per_hour).persist()  # read once for each layer and for the index
        try:
            for layer, condition in layers.items():
                own = held if condition is None else held.filter(condition)
                at = f"{root}/{layer}/batch={name}" if layer else f"{root}/batch={name}"
                own.write.mode("overwrite").format(fmt).partitionBy(*partitions).save(at)
                probe(f"written {layer}", number)
            hours = _hours(spark, held, root, layers, name, partitions)
            hours.coalesce(1).write.mode("overwrite").parquet(f"{root}/_index/{name}")
        finally:
            held.unpersist()
        probe("indexed", number)
        gone = state["old"]
        state = {**state, "last": {**state["last"], writer: number}, "loose": [*state["loose"], name], "old": []}
        if len(state["loose"]) >= merge:
            state = _merge(spark, root, state, name)
        swap(spark, f"{root}/_committed", json.dumps({**state, "old": state["old"] or gone}))
        if state["old"]:
            for entry in gone:
                drop(spark, f"{root}/_index/{entry}")
        probe("committed", number)

    return write


def _hours(spark: SparkSession, held: DataFrame, root: str, layers, name: str, partitions: Sequence[str]) -> DataFrame:
    """The index entries of a batch. With one folder for all layers, the column ``branch`` tells them."""
    wanted = [F.col(c).cast("int").alias(c) for c in PARTITIONS]
    batch = F.lit(name).alias("batch")
    if "branch" in partitions:
        return held.select(F.col("branch").alias("layer"), *wanted, batch).distinct()
    told = F.array(*[F.lit(layer) if c is None else F.when(c, F.lit(layer)) for layer, c in layers.items()])
    return held.select(F.explode(told).alias("layer"), *wanted, batch).filter("layer IS NOT NULL").distinct()


def write_committed(
    df: DataFrame,
    root: str,
    layers: Mapping[str, Column | None],
    name: str | None = None,
    trigger: str | None = TRIGGER,
    fmt: str = "json",
    partitions: Sequence[str] = PARTITIONS,
    checkpoint: str | None = None,
    files_per_hour: int | None = None,
    merge: int = MERGE,
    probe: Probe = lambda stage, batch: None,
) -> StreamingQuery:
    """Start one query that writes the rows of all ``layers`` of a stream below ``root``.

    Its batches are told by its checkpoint, ``<root>_checkpoint`` unless given: a checkpoint must not be emptied while
    the root stays. Several queries may write to one root one after the other, not at a time.
    """
    spark, checkpoint = df.sparkSession, checkpoint or f"{root}_checkpoint"
    writer = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    if committed(spark, root) is None:  # from now on nothing counts that is not named there
        swap(spark, f"{root}/_committed", json.dumps({"last": {}, "merged": None, "loose": [], "old": []}))
    write = batch_writer(spark, root, layers, writer, fmt, partitions, files_per_hour, merge, probe)
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    started = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**pace).foreachBatch(write)
    return (started.queryName(name) if name else started).start()
