"""Row filters and per-row verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.checks import fully_matches, is_iso_time, skewed
from millrace.functions.clock import instant, micros
from millrace.operators.parse import decoded, text_schema
from millrace.schema import DOCUMENTED_RANGES, READING_SCHEMA, REQUIRED, Ranges


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows where any required field is null or NaN."""
    return df.dropna(subset=list(required))


def trailing_window(df: DataFrame, ts: str, as_of, length: str = "1 hour") -> DataFrame:
    """Rows of the ``length`` up to ``as_of``, both ends included."""
    end = instant(as_of)
    start = F.timestamp_micros(F.unix_micros(end) - micros(length))
    return df.filter(F.col(ts).between(start, end))


def label_regex_filter(m: DataFrame, label: str, regex: str = ".*") -> DataFrame:
    return m.filter(fully_matches(F.col(label), regex))


def clock_skew_check(df: DataFrame, tol: str = "1 minute") -> DataFrame:
    """Mark readings whose own time is off the collection time by more than ``tol``."""
    return df.withColumn("skewed", skewed(F.col("time"), F.col("collected_at"), micros(tol)))


def field_verdicts(ranges: Ranges = DOCUMENTED_RANGES) -> dict[str, Column]:
    """Named faults of one message over its fields read as text.

    Missing, no such type and out of range exclude each other for a field; every fault is false, never
    null, for a field that is sound.
    """
    verdicts = {}
    bounds = dict(ranges.items())
    for field in READING_SCHEMA:
        text = F.col(field.name)
        missing = text.isNull() | (F.trim(text) == "")
        verdicts[f"missing_{field.name}"] = missing
        if isinstance(field.dataType, T.StringType):
            verdicts[f"bad_time_{field.name}"] = ~missing & ~is_iso_time(text)
            continue
        typed = text.try_cast(field.dataType)
        wrong = typed.isNull()
        if isinstance(field.dataType, T.DoubleType):
            wrong = wrong | F.isnan(typed)
        verdicts[f"bad_type_{field.name}"] = ~missing & wrong
        if field.name in bounds:
            verdicts[f"out_of_range_{field.name}"] = ~missing & ~wrong & ~typed.between(*bounds[field.name])
    return {name: F.coalesce(fault, F.lit(False)) for name, fault in verdicts.items()}


def strict_reject(
    msgs: DataFrame, ranges: Ranges = DOCUMENTED_RANGES, keep: Sequence[str] = ()
) -> DataFrame:
    """Every message with the list of reasons to refuse it; an accepted one has an empty list."""
    verdicts = field_verdicts(ranges)
    reasons = F.array(*[F.when(fault, name).otherwise("") for name, fault in verdicts.items()])
    fields = decoded(msgs, text_schema(), [*keep, "value"])
    return fields.select(*keep, "value", F.array_remove(reasons, "").alias("reasons"))
