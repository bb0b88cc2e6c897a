"""The monitors: metric snapshots of the layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.alerts import alert_threshold
from millrace.operators.metrics import error_count_per_device, latest_per_device, threshold_band, to_metrics
from millrace.operators.parse import project_metrics
from millrace.operators.series import avg_over_time, counter_increase_grid
from millrace.schema import ERROR_ALERT_LIMIT, ERROR_COUNT_STEPS, LATENCY_STEPS
from millrace.sources.layers import scan_layer
from millrace.streaming.progress import state_metrics


def latest_metrics(readings: DataFrame, prefix: str = "") -> DataFrame:
    """Newest values of each device as metric samples."""
    return to_metrics(project_metrics(latest_per_device(readings)), prefix)


def error_metrics(dataerr: DataFrame, as_of, metric: str = "error_count_per_hour") -> DataFrame:
    """Implausible readings of the last hour per device as metric samples."""
    counts = error_count_per_device(dataerr, as_of)
    return to_metrics(counts.withColumnRenamed("error_count", metric), measures=[metric])


def monitor_layer(
    spark: SparkSession, root: str, layer: str | None, start, end, prefix: str = "", **layout
) -> DataFrame:
    """Snapshot straight from a written layer; only the hours of [start, end) are read."""
    return latest_metrics(scan_layer(spark, root, layer, start, end, **layout), prefix)


def monitor_errors(
    spark: SparkSession, root: str, as_of: datetime, metric: str = "error_count_per_hour", **layout
) -> DataFrame:
    """Implausible readings of the hour before ``as_of``; the two hours it touches are read."""
    start, end = as_of - timedelta(hours=1), as_of + timedelta(microseconds=1)
    return error_metrics(scan_layer(spark, root, "dataerr", start, end, **layout), as_of, metric)


def records_per_minute(
    progress: DataFrame, window: str = "30 seconds", mean: str = "1 minute", step: str = "30 seconds"
) -> DataFrame:
    """Mean growth of the readings held by each query: ``name``, ``ts``, ``mean``, ``steps``."""
    held = state_metrics(progress).filter(F.col("metric").endswith("_states_rowsTotal"))
    grown = counter_increase_grid(held, window, step, series=("name",))
    return avg_over_time(grown, mean, step, series=("name",))


def batch_latency_bands(progress: DataFrame, steps=LATENCY_STEPS) -> DataFrame:
    """Latency of every micro-batch with the colour of its band."""
    latency = state_metrics(progress).filter(F.col("metric").endswith("_latency"))
    return threshold_band(latency, steps)


def counter_metrics(events: DataFrame) -> DataFrame:
    """A counter per device that restarts now and then, sampled at each event."""
    return events.select(
        F.lit("events_total").alias("metric"),
        (F.col("user_id") % 5 + 1).cast("string").alias("device_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 400).cast("double").alias("value"),
    )


def value_metrics(events: DataFrame) -> DataFrame:
    """Event values as two gauges per device."""
    k = F.get_json_object("props", "$.k").cast("double")
    wide = events.select(
        (F.col("user_id") % 5 + 1).cast("int").alias("DeviceId"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("sensor1"),
        k.alias("sensor2"),
        (F.col("value") + k).alias("sensor3"),
    )
    return to_metrics(wide, measures=("sensor1", "sensor2", "sensor3"), keep=("ts",))


def restless_metrics(events: DataFrame, ends) -> DataFrame:
    """Event values as a gauge per device, on batch and stream: some samples are no number, the first device falls silent
    at ``ends``, the second every night."""
    ts, device = F.col("ts").cast("timestamp"), F.col("user_id") % 5 + 1
    silent = ((device == 1) & (ts >= F.lit(ends).cast("timestamp"))) | ((device == 2) & F.hour(ts).between(3, 5))
    return events.filter(F.col("ts").isNotNull() & ~silent).select(
        F.lit("sensor1").alias("metric"),
        device.cast("string").alias("device_id"),
        ts.alias("ts"),
        F.when(F.col("event_id") % 97 == 0, float("nan")).otherwise(F.col("value")).alias("value"),
    )


def error_alerts(m: DataFrame, limit: float = ERROR_ALERT_LIMIT, **timing) -> DataFrame:
    """Whether a device has more errors an hour than it may, at each evaluation."""
    return alert_threshold(m, ">", limit, **timing)


def error_bands(counts: DataFrame, steps=ERROR_COUNT_STEPS) -> DataFrame:
    """Error counts with the colour of their band."""
    return threshold_band(counts, steps)


def hourly_error_metrics(dataerr: DataFrame, metric: str = "error_count_per_hour") -> DataFrame:
    """Implausible readings per device and hour, sampled when the hour is over."""
    end = F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")
    counts = dataerr.filter("ts IS NOT NULL").groupBy("DeviceId", end.alias("ts")).agg(
        F.count("*").alias(metric)
    )
    return to_metrics(counts, measures=(metric,), keep=("ts",))


def host_metrics(part: DataFrame, labels: Sequence[str] = ("job", "instance")) -> DataFrame:
    """Parts as memory readings of twenty hosts, one sample of either metric per minute."""
    price = F.col("p_retailprice")
    wide = part.select(
        F.when(F.col("p_partkey") % 20 < 15, "node").otherwise("spark").alias("job"),
        (F.col("p_partkey") % 20).cast("string").alias("instance"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("p_partkey") / 20) * 60).alias("ts"),
        (price * F.col("p_size") / 100).alias("mem_available"),
        price.alias("mem_total"),
    )
    return wide.unpivot([*labels, "ts"], ["mem_available", "mem_total"], "metric", "value")
