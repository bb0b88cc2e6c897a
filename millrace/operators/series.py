"""Order-dependent work on time series, cut by time so that no series has to fit one task.

A device may own a third of all rows. Windows over a whole device would put those rows into one task, so
every window here is bounded by the clock: it runs inside one slice of a series, or over one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clock import as_timestamp, ceil_to, floor_to, from_micros, instant, micros, to_micros
from millrace.operators.metrics import SERIES

SLICE = "1 minute"
#: Buckets of a window over counters at most; buckets of longer windows are wider than a slice.
MOST = 1440
#: Parts that the rows without a time are spread over.
UNDATED = 1024


def _growth(previous: Column, value: Column) -> Column:
    """Step of a counter from one sample to the next; after a drop it has restarted from zero."""
    return F.when(value < previous, value).otherwise(value - previous)


def _width(length: int, unit: int, least: int) -> int:
    """Microseconds of a bucket: a part of ``unit``, about ``least`` or more, of which ``length`` has ``MOST`` at most,
    if that can be."""
    return next(unit // k for k in range(max(1, unit // least), 0, -1) if unit % k == 0 and (k == 1 or length * k <= MOST * unit))


def _stepped(m: DataFrame, bucket, series: Sequence[str]) -> DataFrame:
    """Samples by bucket, with the value and time before each, and its step from there, within the bucket."""
    rows = m.filter("value IS NOT NULL").select(*series, to_micros(F.col("ts")).alias("us"), "value")
    rows = rows.withColumn("bucket", bucket(F.col("us")))
    forward = Window.partitionBy(*series, "bucket").orderBy("us", "value")
    return rows.withColumns(
        {
            "prev_us": F.lag("us").over(forward),
            "step": F.coalesce(_growth(F.lag("value").over(forward), F.col("value")), F.lit(0.0)),
            "step_next": F.coalesce(_growth(F.col("value"), F.lead("value").over(forward)), F.lit(0.0)),
            "grown": F.lit(0.0),
        }
    ).withColumn("grown", F.sum("step").over(forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _summed(stepped: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per bucket: its first and last sample, its samples and the growth within it."""
    return stepped.groupBy(*series, "bucket").agg(
        F.min(F.struct("us", "value")).alias("first"),
        F.max(F.struct("us", "value")).alias("last"),
        F.sum("step").alias("inside"),
        F.count("*").alias("rows"),
    )


def counter_increase(
    m: DataFrame, window: str = "30 seconds", series: Sequence[str] = SERIES, bucket: str = SLICE
) -> DataFrame:
    """Growth of each counter over the ``window`` up to each of its samples, both ends included.

    Null where the window holds one sample only. The window has ``n`` buckets. Growth is the sum of the steps from the
    start of the window to the end of the bucket it is in, of the ``n - 1`` whole buckets behind that one, and of the
    steps from the start of the sample's own bucket. Nothing is subtracted, so a small step after a large one is not
    lost; samples are never copied per window, and windows over a series have one row per bucket.
    """
    length = micros(window)
    width = _width(length, length, micros(bucket))
    n = length // width
    inner = _stepped(m, lambda us: F.floor(us / width), series)
    line = Window.partitionBy(*series).orderBy("bucket")
    edge = F.coalesce(_growth(F.col("last.value"), F.lead("first.value").over(line)), F.lit(0.0))
    buckets = _summed(inner, series).withColumns({"edge": edge, "before_us": F.lag("last.us").over(line)})
    between = F.sum(F.col("inside") + F.col("edge")).over(line.rangeBetween(1 - n, -1)) if n > 1 else F.lit(0.0)
    buckets = buckets.withColumn("between", F.coalesce(between, F.lit(0.0)))
    ends = inner.join(buckets.select(*series, "bucket", "between", "before_us"), [*series, "bucket"])
    carried = {"us": "long", "value": "double", "later": "double", "prev_us": "long"}
    probes = ends.select(
        *series,
        (F.col("bucket") - n).alias("bucket"),
        (F.col("us") - length).alias("at"),
        F.lit(None).cast("double").alias("step_next"),
        "us",
        "value",
        (F.col("between") + F.col("grown")).alias("later"),
        F.coalesce("prev_us", "before_us").alias("prev_us"),
    )
    none = [F.lit(None).cast(kind).alias(name) for name, kind in carried.items()]
    # The step out of a bucket is one more mark at its last sample.
    marks = inner.select(*series, "bucket", F.col("us").alias("at"), "step_next", *none)
    marks = marks.unionByName(buckets.select(*series, "bucket", F.col("last.us").alias("at"), F.col("edge").alias("step_next"), *none))
    backward = (
        Window.partitionBy(*series, "bucket")
        .orderBy(F.col("at").desc(), F.col("us").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = marks.unionByName(probes).withColumn("sooner", F.sum("step_next").over(backward)).filter("us IS NOT NULL")
    grown = F.when(F.col("prev_us") >= F.col("us") - length, F.coalesce("sooner", F.lit(0.0)) + F.col("later"))
    return found.select(*series, from_micros(F.col("us")).alias("ts"), "value", grown.alias("increase"))


def counter_increase_grid(
    m: DataFrame,
    window: str = "30 seconds",
    step: str = "30 seconds",
    series: Sequence[str] = SERIES,
    bucket: str = SLICE,
) -> DataFrame:
    """The same growth at fixed evaluation times, multiples of ``step``; times with one sample or none have no row.

    Buckets end at evaluation times and are part of a window or not, so samples are looked at once, to sum up their
    bucket. A bucket brings forth the evaluation times from its first sample to the next bucket's, as long as its last
    sample is in the window; each adds up the buckets of its window, and of the steps between them those that start
    in it.
    """
    length, every = micros(window), micros(step)
    width = _width(length, gcd(length, every), micros(bucket))
    n = length // width
    # a bucket includes its end, not its start
    buckets = _summed(_stepped(m, lambda us: F.floor((us - 1) / width), series), series)
    line = Window.partitionBy(*series).orderBy("bucket")
    low, high = ceil_to(F.col("first.us"), every), floor_to(F.col("last.us") + length, every)
    high = F.least(high, ceil_to(F.lead("first.us").over(line), every) - every)
    buckets = buckets.withColumns({"edge": _growth(F.lag("last.value").over(line), F.col("first.value")),
                                   "edge_us": F.lag("last.us").over(line), "low": low, "high": high})
    none = F.array(F.lit(None).cast("long"))
    times = F.when(F.col("low") <= F.col("high"), F.sequence("low", "high", F.lit(every))).otherwise(F.array().cast("array<long>"))
    rows = buckets.withColumn("at", F.explode(F.concat(none, times)))
    rows = rows.withColumn("place", F.coalesce(F.floor(F.col("at") / width) - 1, "bucket"))
    own = F.when(F.col("at").isNull(), F.struct("inside", "rows", F.coalesce("edge", F.lit(0.0)).alias("edge"), "edge_us"))
    frame = Window.partitionBy(*series).orderBy("place").rangeBetween(1 - n, 0)
    held = rows.withColumn("held", F.collect_list(own).over(frame)).filter("at IS NOT NULL")

    def added(total, x):
        starts = F.coalesce(x["edge_us"] >= F.col("at") - length, F.lit(False))
        grown = x["inside"] + F.when(starts, x["edge"]).otherwise(0.0)
        return F.struct((total["grown"] + grown).alias("grown"), (total["steps"] + x["rows"] - 1 + starts.cast("long")).alias("steps"))

    start = F.struct(F.lit(0.0).alias("grown"), F.lit(0).cast("long").alias("steps"))
    found = held.withColumn("sum", F.aggregate("held", start, added))
    return found.filter("sum.steps > 0").select(*series, from_micros(F.col("at")).alias("ts"), F.col("sum.grown").alias("increase"))


def avg_over_time(
    m: DataFrame,
    window: str = "1 minute",
    step: str = "30 seconds",
    value: str = "increase",
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Mean of the values at the steps of the trailing ``window``, re-evaluated at each step.

    Samples off the grid of ``step`` count at the next step, the last one of a step for all. A step that has no value
    is left out of the mean. A step at the far end of the window belongs to the
    window before, so ``1 minute`` of 30-second steps is two of them.
    """
    length, every = micros(window), micros(step)
    us, at = to_micros(F.col("ts")), F.col("tick")
    steps = m.select(*series, ceil_to(us, every).alias("tick"), us.alias("us"), F.col(value).alias(value))
    steps = steps.groupBy(*series, "tick").agg(F.max(F.struct("us", value))[value].alias(value))
    return (
        steps.select(*series, F.explode(F.sequence(at, at + length - every, F.lit(every))).alias("at"), value)
        .groupBy(*series, "at")
        .agg(F.avg(value).alias("mean"), F.count(value).alias("steps"))
        .select(*series, from_micros(F.col("at")).alias("ts"), "mean", "steps")
    )


def instant_value_at(
    m: DataFrame, at, lookback: str = "600 seconds", series: Sequence[str] = SERIES
) -> DataFrame:
    """Last sample of each series in the ``lookback`` up to one instant."""
    end = to_micros(instant(at))
    age = end - to_micros(F.col("ts"))
    return (
        m.filter(F.col("value").isNotNull() & age.between(0, micros(lookback)))
        .groupBy(*series)
        .agg(F.max(F.struct("ts", "value")).alias("last"))
        .select(*series, "last.ts", "last.value")
    )


def evaluations(
    m: DataFrame,
    every: str = "1 minute",
    lookback: str = "600 seconds",
    until=None,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Every series at every evaluation time since its first sample: the last value in the look-back, or
    null. Evaluation ends with ``until``, of which later samples know nothing, else when the last sample of the series
    has left the look-back.

    Samples first shrink, map-side, to one per series and evaluation interval. The window over a series
    then holds as many rows as the clock has ticks, whatever the sample rate, and the gaps between the
    rows are filled by sequences: no join with a grid.
    """
    step, reach = micros(every), micros(lookback)
    end = None if until is None else floor_to(to_micros(instant(until)), step)
    known = F.col("value").isNotNull()
    ticks = (
        m.filter(known if end is None else known & (to_micros(F.col("ts")) <= end))
        .select(*series, ceil_to(to_micros(F.col("ts")), step).alias("tick"), "ts", "value")
        .groupBy(*series, "tick")
        .agg(F.max(F.struct(to_micros(F.col("ts")).alias("us"), "value")).alias("last"))
        .select(*series, "tick", "last.us", "last.value")
    )
    order = Window.partitionBy(*series).orderBy("tick")
    tail = floor_to(F.col("us") + reach, step) if end is None else end
    ahead = F.coalesce(F.lead("tick").over(order) - step, F.greatest("tick", tail))
    return (
        ticks.withColumn("stop", ahead)
        .withColumn("at", F.explode(F.sequence("tick", "stop", F.lit(step))))
        .select(
            *series,
            from_micros(F.col("at")).alias("eval_ts"),
            F.when(F.col("at") - F.col("us") <= reach, F.col("value")).alias("value"),
        )
    )


def _asked(m: DataFrame, times: DataFrame, reach: int, width: int, series: Sequence[str]) -> DataFrame:
    """The series and ``at`` of all values that are asked for and may exist."""
    at = to_micros(F.col("eval_ts").cast("timestamp"))
    named = [c for c in series if c in times.columns]
    asked = times.select(*named, at.alias("at")).filter("at IS NOT NULL").distinct()
    if len(named) == len(series):
        return asked
    # Times for all series: a series is asked for near its samples only, in spans of the clock.
    span = max(width, reach)
    alive = m.select(*series, F.floor(F.col("us") / span).alias("span")).distinct()
    alive = alive.select(*series, F.explode(F.array("span", F.col("span") + 1)).alias("span")).distinct()
    return asked.withColumn("span", F.floor(F.col("at") / span)).join(alive, [*named, "span"]).select(*series, "at")


def instant_value_at_times(
    m: DataFrame, times: DataFrame, lookback: str = "600 seconds", series: Sequence[str] = SERIES, slice_width: str = SLICE
) -> DataFrame:
    """Last sample of each series in the ``lookback`` up to each time of a frame: the series, ``eval_ts``, ``ts``, ``value``.

    ``times`` has ``eval_ts`` and any of the series columns: with all of them, each series has its own times; a time
    without some of them is asked of every series that has the others. A time that is asked twice is answered once, a
    time without a sample has no row.

    An as-of join by union: samples and times of a series are put in order within slices of the clock, and the last
    sample of the slices before enters a slice as one more row. No window spans the samples of a series, and no time
    is paired with more than one sample.
    """
    reach, width = micros(lookback), micros(slice_width)
    known = m.filter("value IS NOT NULL AND ts IS NOT NULL")
    known = known.select(*series, to_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    asked = _asked(known, times, reach, width, series)
    sample = F.struct("us", "value")
    here = F.floor(F.col("at") / width).alias("slice")
    nothing = F.lit(None).cast(f"struct<us:long,value:{m.schema['value'].dataType.simpleString()}>").alias("sample")
    marks = known.select(*series, F.floor(F.col("us") / width).alias("slice"), F.col("us").alias("at"), sample.alias("sample"))
    probes = asked.select(*series, here, "at", nothing)
    # The last sample of a slice, and the slices it is carried into: those that are asked.
    slices = (
        known.groupBy(*series, F.floor(F.col("us") / width).alias("slice")).agg(F.max(sample).alias("last"), F.lit(False).alias("asks"))
        .unionByName(probes.select(*series, "slice").distinct().withColumns({"last": nothing, "asks": F.lit(True)}))
        .groupBy(*series, "slice").agg(F.max("last").alias("last"), F.bool_or("asks").alias("asks"))
    )
    before = Window.partitionBy(*series).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("sample", F.last("last", ignorenulls=True).over(before)).filter("asks AND sample IS NOT NULL")
    start = F.col("slice") * width
    carried = carried.filter(F.col("sample.us") >= start - reach).select(*series, "slice", F.col("sample.us").alias("at"), "sample")
    forward = (
        Window.partitionBy(*series, "slice")
        .orderBy("at", F.col("sample").isNull(), "sample.value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = marks.unionByName(carried).unionByName(probes).withColumn("found", F.last("sample", ignorenulls=True).over(forward))
    found = rows.filter(F.col("sample").isNull() & (F.col("at") - F.col("found.us") <= reach))
    return found.select(
        *series, from_micros(F.col("at")).alias("eval_ts"), from_micros(F.col("found.us")).alias("ts"), F.col("found.value").alias("value")
    )


def instant_value(
    m: DataFrame,
    eval_times: str | DataFrame = "1 minute",
    lookback: str = "600 seconds",
    until=None,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Last sample in the look-back at each evaluation time that has one: at the steps of a grid, or at the times of a
    frame as in :func:`instant_value_at_times`, of which those after ``until`` are left out."""
    if isinstance(eval_times, str):
        return evaluations(m, eval_times, lookback, until, series).filter("value IS NOT NULL")
    times = eval_times if until is None else eval_times.filter(F.col("eval_ts") <= instant(until))
    return instant_value_at_times(m, times, lookback, series).drop("ts")


def time_reversal(df: DataFrame, key: str = "DeviceId", slice_width: str = SLICE) -> DataFrame:
    """Mark readings whose ``time`` is before that of the previous arrival of the same device.

    Arrivals are the distinct collection times of a device, each with its latest ``time``: copies and
    readings of one instant melt into one arrival before the shuffle. The previous arrival is looked up
    inside a slice of the clock. The first arrival of a slice finds it in the slice before: for that, the
    first and last arrivals of all slices of a device form one more group, two rows per slice, while the
    others stay in groups of their slice. The verdicts are then joined back by device and instant, a join
    whose hot keys the engine may split.
    """
    width = micros(slice_width)
    us = to_micros(F.col("ts"))
    arrivals = (
        df.filter("ts IS NOT NULL")
        .select(key, us.alias("_us"), to_micros(as_timestamp(F.col("time"))).alias("seen"))
        .groupBy(key, "_us")
        .agg(F.max("seen").alias("seen"))
        .withColumn("slice", F.floor(F.col("_us") / width))
    )
    inside = Window.partitionBy(key, "slice").orderBy("_us")
    placed = arrivals.withColumns(
        {
            "first": F.lag("_us").over(inside).isNull(),
            "last": F.lead("_us").over(inside).isNull(),
            "inner": F.lag("seen").over(inside),
        }
    ).withColumn("group", F.when(~F.col("first") & ~F.col("last"), F.col("slice")))
    edges = Window.partitionBy(key, "group").orderBy("_us")
    before = placed.withColumn("outer", F.lag("seen").over(edges)).select(
        key, "_us", F.when(F.col("first"), F.col("outer")).otherwise(F.col("inner")).alias("before")
    )
    late = to_micros(as_timestamp(F.col("time"))) < F.col("before")
    # Rows without a time match nothing; spread over salts, those of a device do not travel as one group.
    salt = F.when(F.col("ts").isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(UNDATED))).otherwise(0)
    return (
        df.withColumns({"_us": us, "_salt": salt})
        .join(before.withColumn("_salt", F.lit(0).cast("long")), [key, "_us", "_salt"], "left")
        .select(
            *df.columns,
            from_micros(F.col("before")).alias("previous_time"),
            F.coalesce(late, F.lit(False)).alias("reversed"),
        )
    )
