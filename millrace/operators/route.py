"""Split cleaned readings into failures, implausible values and good data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.checks import branch_label, valid_range
from millrace.schema import DEFAULT_RANGES, Ranges


def route_fail(df: DataFrame) -> DataFrame:
    return df.filter("isFail")


def route_dataerr(df: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    return df.filter(~F.col("isFail") & ~valid_range(ranges))


def route_correct(df: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    return df.filter(~F.col("isFail") & valid_range(ranges))


def route_branch(df: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    return df.withColumn("branch", branch_label(ranges))


def branch_union_cases(
    raw: DataFrame, parts: Mapping[str, DataFrame], cases: Mapping[str, Sequence[str]]
) -> DataFrame:
    """:func:`branch_union_check` for several choices of parts: rows that do not add up, and by how many.

    Raw and every part are read once, each row with the name it comes by; a case is a sum over names. All cases share
    one shuffle.
    """
    cols = raw.columns
    tagged = [raw.select(*cols, F.lit("").alias("part"))]
    tagged += [df.select(*cols, F.lit(name).alias("part")) for name, df in parts.items()]

    def surplus(chosen: Sequence[str]) -> Column:
        weight = F.when(F.col("part") == "", 1)
        for name in dict.fromkeys(chosen):
            weight = weight.when(F.col("part") == name, -chosen.count(name))
        return F.coalesce(F.sum(weight), F.lit(0))

    sums = [surplus(list(chosen)).alias(f"case_{k}") for k, chosen in enumerate(cases.values())]
    found = reduce(DataFrame.unionAll, tagged).groupBy(*cols).agg(*sums)
    each = [
        F.struct(
            F.lit(name).alias("checked"),
            F.count_if(F.col(f"case_{k}") != 0).alias("violations"),
            F.coalesce(F.sum(f"case_{k}"), F.lit(0)).alias("surplus"),
        )
        for k, name in enumerate(cases)
    ]
    return found.agg(F.array(*each).alias("each")).select(F.inline("each"))


def branch_union_check(raw: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Rows that break raw = the parts together, each row counted.

    Rows of raw count +1 and rows of the parts -1; whatever does not add up to zero is lost (``surplus``
    above zero) or present too often (below). One aggregation, combined map-side, replaces a difference
    in each direction.
    """
    cols = raw.columns
    both = reduce(
        DataFrame.unionAll,
        [raw.select(*cols, F.lit(1).alias("sign"))]
        + [part.select(*cols, F.lit(-1).alias("sign")) for part in parts],
    )
    return both.groupBy(*cols).agg(F.sum("sign").alias("surplus")).filter("surplus <> 0")
