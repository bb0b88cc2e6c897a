"""Two ways of cutting a line into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space in each of the two splits.
UNICODE_SPACE = r"(?U)[\s\x1c-\x1f]+"
ASCII_SPACE = r"\s+"


def words_any_space(line: Column) -> Column:
    """Pieces between runs of any Unicode white space; never an empty piece."""
    return F.array_remove(F.split(line, UNICODE_SPACE), "")


def words_ascii_space(line: Column) -> Column:
    """Pieces between runs of ASCII white space, trailing empty pieces dropped.

    A leading separator leaves one empty piece in front; an empty line is one empty piece; a line of
    separators alone has no piece.
    """
    pieces = F.split(F.regexp_replace(line, ASCII_SPACE + r"\z", ""), ASCII_SPACE)
    return F.when(line == "", F.array(F.lit(""))).when(
        line.rlike(r"\A\s+\z"), F.array().cast("array<string>")
    ).otherwise(pieces)
