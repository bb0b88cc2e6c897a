"""Counts of rule violations over raw messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clock import as_timestamp, micros, to_micros
from millrace.operators.clean import field_verdicts
from millrace.operators.parse import decoded, parse_reading, text_schema, time_partitions
from millrace.operators.series import SLICE
from millrace.schema import DEDUP_KEYS, DOCUMENTED_RANGES, Ranges


_FAULTS, _COPIES, _ARRIVALS = 0, 1, 2


def _counted(msgs: DataFrame, issues: dict[str, Column], by: Sequence[str]) -> DataFrame:
    """Messages counted three ways at once: by the faults of their text, by reading, and by device, arrival and time.

    Each message is read and decoded once either way, as text and typed, and gives up to three narrow rows, which are
    added up map-side. ``which`` tells them apart behind the shuffle: as it is an aggregate, no filter on it moves below,
    and all that reads these counts reads one exchange.
    """
    text = time_partitions(decoded(msgs, text_schema(), ["value"]).withColumn("ts", as_timestamp(F.col("collected_at"))))
    bits = reduce(add, [F.when(fault, 1 << k).otherwise(0) for k, fault in enumerate(issues.values())])
    told = text.select(
        "value",
        F.struct(*[F.col(c).try_cast("int").alias(c) for c in by], bits.alias("_faults")).alias("_told"),
    )
    typed = parse_reading(told, keep=["_told"]).withColumn("ts", as_timestamp(F.col("collected_at")))
    typed = time_partitions(typed)
    keyed = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in DEDUP_KEYS if c != "isFail"])
    keyed = keyed & F.col("isFail").isNotNull()
    us, seen = to_micros(F.col("ts")), to_micros(as_timestamp(F.col("time")))
    kinds = {c: typed.schema[c].dataType.simpleString() for c in DEDUP_KEYS}

    def row(which: int, **values: Column) -> Column:
        names = {**{f"by_{c}": "int" for c in by}, "faults": "int", **{f"key_{c}": kinds[c] for c in DEDUP_KEYS}, "us": "bigint", "seen": "bigint"}
        columns = [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in names.items()]
        return F.struct(F.lit(which).alias("kind"), *columns)

    own = {f"by_{c}": F.col(c) for c in by}
    rows = F.array(
        row(_FAULTS, **{f"by_{c}": F.col(f"_told.{c}") for c in by}, faults=F.col("_told._faults")),
        F.when(keyed, row(_COPIES, **own, **{f"key_{c}": F.col(c) for c in DEDUP_KEYS})),
        F.when(keyed & us.isNotNull(), row(_ARRIVALS, **own, key_DeviceId=F.col("DeviceId"), us=us, seen=seen)),
    )
    each = typed.select(F.inline(rows)).filter("kind IS NOT NULL")
    return each.groupBy(*each.columns).agg(F.count("*").alias("n"), F.max("kind").alias("which"))


def _reversals(arrivals: DataFrame, by: Sequence[str], width: int = micros(SLICE)) -> DataFrame:
    """Readings whose time is before that of the previous arrival of their device: within slices of the clock, into
    which the last arrival of the slices before is carried."""
    rows = arrivals.select("key_DeviceId", "us", "seen", "n", *[f"by_{c}" for c in by])
    rows = rows.withColumn("slice", F.floor(F.col("us") / width))
    slices = rows.groupBy("key_DeviceId", "slice").agg(F.max(F.struct("us", "seen")).alias("last"))
    line = Window.partitionBy("key_DeviceId").orderBy("slice")
    carried = slices.withColumn("before", F.lag("last").over(line)).filter("before IS NOT NULL")
    carried = carried.select("key_DeviceId", "slice", F.col("before.us").alias("us"), F.col("before.seen").alias("seen"))
    earlier = (
        Window.partitionBy("key_DeviceId", "slice").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    )
    both = rows.unionByName(carried, allowMissingColumns=True).withColumn("before", F.max(F.struct("us", "seen")).over(earlier))
    late = both.filter("n IS NOT NULL AND seen < before.seen")
    return late.groupBy(*[f"by_{c}" for c in by]).agg(F.sum("n").alias("messages"))


def quality_report(
    msgs: DataFrame, ranges: Ranges = DOCUMENTED_RANGES, by: Sequence[str] = ()
) -> DataFrame:
    """Messages per kind of issue, optionally per device and time part (``by``).

    missing, bad_time, type_mismatch, out_of_range and wrong_device are per-message faults. duplicate counts copies
    beyond the first, time_reversal readings that ran backwards. Messages are read once for all of them.
    """
    faults = field_verdicts(ranges)

    def any_of(start: str, but: str = "") -> Column:
        return reduce(or_, [v for name, v in faults.items() if name.startswith(start) and name != but])

    wrong_device = "out_of_range_DeviceId"
    issues = {
        "missing": any_of("missing_"),
        "bad_time": any_of("bad_time_"),
        "type_mismatch": any_of("bad_type_"),
        "out_of_range": any_of("out_of_range_", but=wrong_device),
        "wrong_device": faults[wrong_device],
    }
    counted = _counted(msgs, issues, by)
    groups = [f"by_{c}" for c in by]

    def total(values: Column) -> Column:
        return F.coalesce(F.sum(values), F.lit(0)).cast("long")

    of = F.col("which")
    rows = counted.filter("n > 0")  # all that read the counts ask for the same columns
    found = rows.filter(of != _ARRIVALS).groupBy(*groups).agg(
        *[total(F.when(F.col("faults").bitwiseAND(1 << k) != 0, F.col("n"))).alias(name) for k, name in enumerate(issues)],
        total(F.when(of == _COPIES, F.col("n") - 1)).alias("duplicate"),
        F.lit(0).cast("long").alias("time_reversal"),
        F.count_if(of == _FAULTS).alias("told"),
        F.count_if(of == _COPIES).alias("typed"),
    )
    long = found.unpivot([*groups, "told", "typed"], [*issues, "duplicate", "time_reversal"], "issue", "messages")
    if by:  # a group may be one of texts or of readings only
        long = long.filter(F.when(F.col("issue").isin(*issues), F.col("told") > 0).otherwise(F.col("typed") > 0))
    turned = _reversals(rows.filter(of == _ARRIVALS), by).withColumn("issue", F.lit("time_reversal"))
    both = long.drop("told", "typed").unionByName(turned).groupBy(*groups, "issue").agg(F.sum("messages").alias("messages"))
    return both.select(*[F.col(f"by_{c}").alias(c) for c in by], "issue", "messages")
