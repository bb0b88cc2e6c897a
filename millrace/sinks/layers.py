"""Hour-partitioned datasets from batch and from streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.schema import DEDUP_KEYS, PARTITIONS, TRIGGER
from millrace.session import settings


def _packed(df: DataFrame, partitions: Sequence[str], files_per_hour: int | None) -> DataFrame:
    """Bring the rows of one directory together, so that it gets few files.

    A hot hour must not end up in one task. In batch the rebalance hint leaves it to the engine to split
    large partitions and to merge small ones by their measured size. A stream has no such step: there the
    rows of an hour are spread over ``files_per_hour`` tasks by a hash of the reading. Take that number from the
    size expected of an hour; it is also how many files each batch adds to it.
    """
    if not df.isStreaming:
        return df.hint("rebalance", *partitions)
    return spread(df, partitions, files_per_hour)


def spread(df: DataFrame, partitions: Sequence[str], files_per_hour: int | None) -> DataFrame:
    """The rows of a directory in ``files_per_hour`` tasks; None leaves them where they are."""
    if files_per_hour is None:
        return df
    salt = F.pmod(F.xxhash64(*DEDUP_KEYS), F.lit(files_per_hour))
    return df.repartition(*[F.col(c) for c in partitions], salt)


def write_layer(
    df: DataFrame,
    path: str,
    name: str | None = None,
    trigger: str | None = TRIGGER,
    fmt: str = "json",
    partitions: Sequence[str] = PARTITIONS,
    checkpoint: str | None = None,
    files_per_hour: int | None = None,
    least_share: str | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Append readings under ``path`` by year, month, day and hour.

    A stream starts a query with its own checkpoint, ``<path>_checkpoint`` unless given, which runs every
    ``trigger``, or with None over what is there now and then ends. In batch, ``least_share`` is the least size of
    what one task writes: less than the engine's default where there are many small hours, since opening files costs
    more than moving few bytes.
    """
    packed = _packed(df, partitions, files_per_hour)
    if not df.isStreaming:
        wanted = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": least_share} if least_share else {}
        with settings(df.sparkSession, wanted):
            packed.write.mode("append").format(fmt).options(**options).partitionBy(*partitions).save(path)
        return None
    pace = {"processingTime": trigger} if trigger else {"availableNow": True}
    writer = (
        packed.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint or f"{path}_checkpoint")
        .partitionBy(*partitions)
        .trigger(**pace)
    )
    return (writer.queryName(name) if name else writer).start(path)
