"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_source(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """A streaming frame over a topic (``fmt="kafka"``) or over files that keep arriving.

    A topic is read from its latest offsets unless ``startingOffsets`` says otherwise, as the format does
    by default. Rates are bounded with ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def archive_source(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """The same from the beginning. Where to go on after a restart is kept in the checkpoint of the query
    that reads it, in place of offsets committed for a consumer group."""
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    return stream_source(spark, fmt, **options)


def exactly(path: str) -> str:
    """A pattern for this path and no other; a file source takes a single file as a pattern only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def table_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream the files of a parquet table, given as one file or as a directory of files."""
    schema = spark.read.parquet(path).schema
    return stream_source(spark, "parquet", path=exactly(path), schema=schema, **options)
