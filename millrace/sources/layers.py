"""Read hour-partitioned layers back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clock import as_timestamp
from millrace.schema import PARTITIONS, READING_SCHEMA
from millrace.sinks.committed import batch_index, committed, valid_batches


def _utc(at: datetime | str) -> datetime:
    moment = datetime.fromisoformat(at) if isinstance(at, str) else at
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def partition_bounds(start: datetime | str | None, end: datetime | str | None) -> Column:
    """Hours touched by [start, end) as plain comparisons of the four partition columns; None bounds nothing.

    Nested so that each level only matters where the ones above are equal; file listings and catalogs can
    prune by such comparisons.
    """
    def side(moment: datetime, strict, loose) -> Column:
        values = [moment.year, moment.month, moment.day, moment.hour]
        out = loose(F.col("hour"), values[-1])
        for name, value in reversed(list(zip(PARTITIONS, values))[:-1]):
            out = strict(F.col(name), value) | ((F.col(name) == value) & out)
        return out

    out = F.lit(True)
    if start is not None:
        out = side(_utc(start), lambda c, v: c > v, lambda c, v: c >= v)
    if end is not None:
        last = _utc(end) - timedelta(microseconds=1)
        out = out & side(last, lambda c, v: c < v, lambda c, v: c <= v)
    return out


def hour_folders(start: datetime | str, end: datetime | str) -> str:
    """A path pattern for the folders of the hours that [start, end) touches, with and without leading zeros."""
    hour, last = _utc(start).replace(minute=0, second=0, microsecond=0), _utc(end) - timedelta(microseconds=1)
    days: dict[tuple, list[int]] = {}
    while hour <= last:
        days.setdefault((hour.year, hour.month, hour.day), []).append(hour.hour)
        hour += timedelta(hours=1)

    def either(values: Sequence[int]) -> str:
        return "{" + ",".join(dict.fromkeys(f for v in values for f in (str(v), f"{v:02d}"))) + "}"

    paths = [f"year={y}/month={either([m])}/day={either([d])}/hour={either(hours)}" for (y, m, d), hours in days.items()]
    return "{" + ",".join(paths) + "}"


def layer_schema(partitions: Sequence[str]) -> T.StructType:
    kinds = {"branch": T.StringType(), "batch": T.StringType()}
    extra = [T.StructField(name, kinds.get(name, T.IntegerType())) for name in partitions]
    return T.StructType([*READING_SCHEMA.fields, *extra])


def _indexed(spark: SparkSession, root: str, state: dict, layer: str | None, separate: bool, bounds: Column) -> list[str]:
    """The folders of the hours within bounds, as the index has them."""
    rows = batch_index(spark, root, state).filter(bounds)
    if layer is not None:
        rows = rows.filter(F.col("layer") == layer)
    base = f"{root}/{layer}" if separate else root
    return [
        f"{base}/batch={r.batch}/" + ("" if separate else f"branch={r.layer}/") + "/".join(f"{c}={r[c]}" for c in PARTITIONS)
        for r in rows.distinct().collect()  # one row per folder that is read
    ]


def scan_layer(
    spark: SparkSession,
    root: str,
    layer: str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    fmt: str = "json",
    separate: bool = False,
    by_folder: bool = False,
) -> DataFrame:
    """Readings of one layer (None: of all) with event time in [start, end), reading only those hours.

    Either bound may be left out. Of a root whose batches are committed (:mod:`millrace.sinks.committed`) only valid
    batches are read, and with a bound only the folders that the index has for those hours are listed, which is what a
    monitor over years of hours needs. For other roots ``by_folder``, with both bounds, does so by the names of the folders; it
    passes over the log in which a stream notes the files it has committed, so it is for roots written in batch.

    The event time is taken from ``collected_at``, which keeps the microseconds that the JSON form of a
    timestamp drops. Month or hour directories with and without a leading zero read alike. Nothing written
    yet is an empty frame, not an error.
    """
    if separate and layer is None:
        raise ValueError("with a directory for each layer, name the layer")
    partitions = PARTITIONS if separate else ("branch", *PARTITIONS)
    base = f"{root}/{layer}" if separate else root
    state = committed(spark, root)
    schema = layer_schema(partitions if state is None else ("batch", *partitions))
    paths = [base]
    if state is not None and (start is not None or end is not None):
        paths = _indexed(spark, root, state, layer, separate, partition_bounds(start, end))
    elif state is None and by_folder and start is not None and end is not None:
        branch = "" if separate else f"branch={layer or '*'}/"
        paths = [f"{base}/{branch}{hour_folders(start, end)}"]
    try:
        reader = spark.read.schema(schema).format(fmt).option("basePath", base)
        df = reader.load(paths) if paths else spark.createDataFrame([], schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    if state is not None:
        df = df.filter(valid_batches(state)).drop("batch")
    df = df.withColumn("ts", as_timestamp(F.col("collected_at")))
    if layer is not None and not separate:
        df = df.filter(F.col("branch") == layer)
    if start is not None or end is not None:
        df = df.filter(partition_bounds(start, end))
    if start is not None:
        df = df.filter(F.col("ts") >= F.lit(_utc(start)).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col("ts") < F.lit(_utc(end)).cast("timestamp"))
    return df
