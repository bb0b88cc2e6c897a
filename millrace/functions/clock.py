"""Times and lengths as whole microseconds, so that window edges are exact."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def micros(length: str | timedelta) -> int:
    """``"30 seconds"`` or a timedelta as microseconds."""
    if isinstance(length, timedelta):
        return length // timedelta(microseconds=1)
    amount, unit = length.split()
    return int(amount) * _UNITS[unit.rstrip("s")] * 1_000_000


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def as_timestamp(text: Column) -> Column:
    """ISO text to timestamp; text that is no time becomes null instead of failing the job.

    So does a time without a date, which a cast would place on the day of the run.
    """
    return F.when(text.rlike(r"^\s*[+-]?\d{4}"), text.try_cast("timestamp"))


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def floor_to(us: Column, step: int) -> Column:
    return us - F.pmod(us, F.lit(step))


def ceil_to(us: Column, step: int) -> Column:
    return floor_to(us + F.lit(step - 1), step)


def instant(at) -> Column:
    """A point in time given as a Column, a datetime or ISO text (UTC)."""
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")
