"""Text outputs and metric snapshots."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.metrics import to_exposition
from millrace.sinks.pointer import drop, folders, pointed, swap

#: Snapshots that stay beside the valid one, for readers that have begun.
FORMER = 1


def write_kv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``word<TAB>count`` lines."""
    df.select(F.concat_ws("\t", "word", F.col("n").cast("string"))).write.mode(mode).text(path)


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    df.select(col).write.mode(mode).text(path)


def _write_version(df: DataFrame, path: str, fmt: str, former: int) -> None:
    spark, now = df.sparkSession, datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    name = f"version-{now}-{uuid4().hex[:8]}"
    df.write.format(fmt).save(f"{path}/{name}")
    before = pointed(spark, f"{path}/_current")
    swap(spark, f"{path}/_current", name)
    # Whatever is older than the last ones that were valid goes, also what a failed write has left.
    kept = sorted(n for n in folders(spark, path, "version-") if n <= (before or ""))[-former:] if former else []
    for old in folders(spark, path, "version-"):
        if old != name and old not in kept and old < name:
            drop(spark, f"{path}/{old}")


def write_snapshot(metrics: DataFrame, path: str, former: int = FORMER) -> None:
    """Replace the last snapshot as a whole: devices that fell silent vanish, no rows clear it all.

    Each snapshot is a version of its own below ``path``, and becomes the valid one by the swap of a pointer once it is
    complete; so :func:`read_snapshot` finds the old one or the new one, at any time, and after a failed write the old
    one. ``former`` versions stay for readers that have begun, older ones go. One writer at a time.
    """
    _write_version(metrics, path, "parquet", former)


def write_exposition(metrics: DataFrame, path: str, former: int = FORMER) -> None:
    """The snapshot as scrape lines, replacing the last in the same way."""
    _write_version(to_exposition(metrics).select("line"), path, "text", former)


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """The folder of the valid snapshot; None before the first."""
    name = pointed(spark, f"{path}/_current")
    return name and f"{path}/{name}"


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The valid snapshot."""
    at = current_snapshot(spark, path)
    if at is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    return spark.read.format(fmt).load(at)
