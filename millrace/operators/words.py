"""Word counts over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.tokens import words_any_space, words_ascii_space


def word_split_ws(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.select(F.explode(words_any_space(F.col(col))).alias("word"))


def word_split_java(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.select(F.explode(words_ascii_space(F.col(col))).alias("word"))


def word_count(tokens: DataFrame) -> DataFrame:
    """Occurrences per word, combined map-side."""
    return tokens.groupBy("word").agg(F.count("*").alias("n"))
