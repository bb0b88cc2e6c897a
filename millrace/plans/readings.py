"""Messages to labelled readings, and readings out of a generic event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import from_micros, iso, to_micros
from millrace.operators.clean import drop_incomplete
from millrace.operators.dedup import dedup_exact
from millrace.operators.parse import event_time, parse_reading, time_partitions
from millrace.operators.route import route_branch
from millrace.schema import DEFAULT_RANGES, READING_SCHEMA, Ranges


def complete_readings(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Messages parsed, complete and dated, row by row, on batch or stream."""
    return event_time(drop_incomplete(parse_reading(messages, keep=keep)))


def labelled(readings: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    """Add the partition columns and the branch."""
    return route_branch(time_partitions(readings), ranges)


def labelled_readings(
    messages: DataFrame, ranges: Ranges = DEFAULT_RANGES, keep: Sequence[str] = ()
) -> DataFrame:
    return labelled(complete_readings(messages, keep), ranges)


def distinct_layers(messages: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    """All layers of a batch of messages, told apart by ``branch``.

    Labels are added behind the deduplication, so its shuffle does not carry them. They depend on its keys
    only: a filter on the branch still moves below it.
    """
    return labelled(dedup_exact(complete_readings(messages)), ranges)


def event_readings(events: DataFrame, device_clock_lag: bool = False) -> DataFrame:
    """Events as readings, with the faults real feeds have: missing values, missing and bad times, foreign devices.

    ``device_clock_lag`` lets the device clock run up to two minutes behind the collector's.
    """
    ts = F.col("ts").cast("timestamp")
    seen = from_micros(to_micros(ts) - F.col("event_id") % 7 * 20_000_000) if device_clock_lag else ts
    k = F.get_json_object("props", "$.k").cast("double")
    event = F.col("event_id")
    return events.select(
        F.when(event % 89 != 0, iso(seen)).alias("time"),
        (F.col("user_id") % 5 + F.when(event % 151 == 0, 98).otherwise(1)).cast("int").alias("DeviceId"),
        F.when(event % 97 != 0, F.col("value")).alias("sensor1"),
        k.alias("sensor2"),
        (F.col("value") + k).alias("sensor3"),
        (event * 37 % 2100).cast("double").alias("motor1"),
        (event * 53 % 1550).cast("double").alias("motor2"),
        (event * 71 % 1850).cast("double").alias("motor3"),
        (F.col("event_type") == "error").alias("isFail"),
        F.when(event % 131 == 0, "garbage").otherwise(iso(ts)).alias("collected_at"),
        "event_id",
    )


def event_messages(events: DataFrame, device_clock_lag: bool = False) -> DataFrame:
    """Those readings as messages, some cut off, every fiftieth sent twice; for batch and stream."""
    fields = F.struct(*[F.col(name) for name in READING_SCHEMA.fieldNames()])
    event = F.col("event_id")
    copies = F.when(event % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    value = F.when(event % 211 == 0, '{"DeviceId":').otherwise(F.to_json(fields))
    # As an element the text is made once, however often a later filter looks at it.
    texts = event_readings(events, device_clock_lag).select(
        "event_id", F.col("DeviceId").cast("string").alias("key"), F.explode(F.array(value)).alias("value")
    )
    return texts.select("event_id", F.explode(copies).alias("copy"), "key", "value")
