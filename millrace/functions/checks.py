"""Predicates and labels over reading columns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.clock import as_timestamp, to_micros
from millrace.schema import DEFAULT_RANGES, Ranges

# Bare NaN and infinities are values to this format, single quotes are not string marks.
_STRICT_JSON = {"allowSingleQuotes": "false"}
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})?$"


def within(name: str, bounds: tuple[float, float]) -> Column:
    return F.col(name).between(*bounds)


def valid_range(ranges: Ranges = DEFAULT_RANGES) -> Column:
    """All bounds hold. The failure flag needs no test of its own: after cleaning it is never null."""
    return reduce(and_, [within(name, bounds) for name, bounds in ranges.items()])


def branch_label(ranges: Ranges = DEFAULT_RANGES) -> Column:
    """fail, dataerr or data. A failed reading is a failure whatever its values are."""
    valid = valid_range(ranges)
    return (
        F.when(F.col("isFail"), F.lit("fail"))
        .when(~F.col("isFail") & valid, F.lit("data"))
        .when(~F.col("isFail") & ~valid, F.lit("dataerr"))
    )


def is_json(text: Column) -> Column:
    """The text is exactly one JSON document.

    A JSON reader stops after the first document, so junk behind it would pass. Here the text becomes the
    first element of an array whose second is a digest of it: the digest is found in its place only if the
    text in front is one whole document, since text that closes the array early or adds elements would
    have to contain its own digest.
    """
    mark = F.sha2(text, 256)
    listed = F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))
    second = F.get(F.from_json(listed, "array<string>", _STRICT_JSON), F.lit(1))
    return F.coalesce(second == mark, F.lit(False))


def is_iso_time(text: Column) -> Column:
    return F.coalesce(text.rlike(_ISO) & as_timestamp(text).isNotNull(), F.lit(False))


def skewed(time: Column, reference: Column, tolerance: int) -> Column:
    """The two ISO times differ by more than the tolerance (microseconds); null if either is no time."""
    gap = to_micros(as_timestamp(time)) - to_micros(as_timestamp(reference))
    return F.abs(gap) > tolerance


def fully_matches(text: Column, regex: str) -> Column:
    """Label matchers cover the whole value, never a part of it."""
    return text.rlike(rf"\A(?s:{regex})\z")
