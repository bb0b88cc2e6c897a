"""Long metric frames (metric, device_id, [ts,] value) and the summaries drawn from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.clean import trailing_window
from millrace.schema import MEASURES

Steps = Sequence[tuple[float | None, str]]
SERIES = ("metric", "device_id")


def latest_per_device(
    df: DataFrame, order: Sequence[str] = ("time", "collected_at"), key: str = "DeviceId"
) -> DataFrame:
    """The newest row of each device, null times last, ties settled by the measures.

    The limit of one row is applied before the shuffle as well, so a device with a third of all rows
    sends one row per map task.
    """
    ties = [*order, *[c for c in MEASURES if c in df.columns]]
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in ties])
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def to_metrics(
    df: DataFrame,
    prefix: str = "",
    measures: Sequence[str] = MEASURES,
    key: str = "DeviceId",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per device and measure; null values have none."""
    doubles = [F.col(c).cast("double").alias(c) for c in measures]
    ids = [F.col(key).cast("string").alias("device_id"), *[F.col(c) for c in keep]]
    long = df.select(*ids, *doubles).unpivot(["device_id", *keep], list(measures), "measure", "value")
    return long.filter("value IS NOT NULL").select(
        F.concat(F.lit(prefix), "measure").alias("metric"), "device_id", *keep, "value"
    )


def error_count_per_device(dataerr: DataFrame, as_of, length: str = "1 hour") -> DataFrame:
    return trailing_window(dataerr, "ts", as_of, length).groupBy("DeviceId").agg(
        F.count("*").alias("error_count")
    )


def device_count(latest: DataFrame) -> DataFrame:
    return latest.agg(F.count("*").alias("devices"))


def is_empty(df: DataFrame, cases: Mapping[str, Column]) -> DataFrame:
    """``checked``, ``empty``: whether no row meets the condition of the case. One aggregation answers all cases, when
    the frame is read."""
    counted = df.agg(*[(F.count_if(condition) == 0).alias(name) for name, condition in cases.items()])
    return counted.unpivot([], list(cases), "checked", "empty")


def label_values(m: DataFrame, metric: str, label: str = "device_id") -> DataFrame:
    return m.filter(F.col("metric") == metric).select(label).distinct().orderBy(label)


def branch_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("branch").agg(F.count("*").alias("readings"))


def hourly_branch_counts(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """Readings per device, hour of event time and branch."""
    return (
        df.groupBy(F.window("ts", width).alias("w"), "DeviceId", "branch")
        .agg(F.count("*").alias("readings"))
        .select(F.col("w.start").alias("hour_start"), "DeviceId", "branch", "readings")
    )


def legend_reduce(m: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """First and last non-null value and the mean of each series."""
    known = F.col("value").isNotNull()
    return m.groupBy(*series).agg(
        F.min(F.when(known, F.struct("ts", "value")))["value"].alias("first"),
        F.avg("value").alias("mean"),
        F.max(F.when(known, F.struct("ts", "value")))["value"].alias("last"),
    )


def legend_sort(reduced: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Largest last value first; equal ones by series."""
    return reduced.orderBy(F.col("last").desc_nulls_last(), *series)


def metric_ratio_join(
    m: DataFrame,
    avail: str,
    total: str,
    on: Sequence[str] = ("instance", "ts"),
    where: Column | None = None,
) -> DataFrame:
    """``(1 - avail / total) * 100`` for samples of two metrics with equal labels and time.

    Both metrics sit in one table, so the one-to-one match is a conditional aggregation: one scan and one
    shuffle with map-side combine, where a self-join would take two of each. A sample without its
    counterpart gives no row; a total of zero gives a null value.
    """
    if where is not None:
        m = m.filter(where)

    def side(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    pairs = (
        m.filter(F.col("metric").isin(avail, total))
        .groupBy(*on)
        .agg(side(avail).alias("_avail"), side(total).alias("_total"))
        .filter("_avail IS NOT NULL AND _total IS NOT NULL")
    )
    used = (1 - F.col("_avail") / F.nullif(F.col("_total"), F.lit(0.0))) * 100
    return pairs.select(*on, used.alias("value"))


def band(value: Column, steps: Steps) -> Column:
    """Colour of the highest step the value reaches; null for no value."""
    base = next(colour for bound, colour in steps if bound is None)
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, colour in sorted([s for s in steps if s[0] is not None], reverse=True):
        out = out.when(value >= bound, colour)
    return out.otherwise(base)


def threshold_band(m: DataFrame, steps: Steps | Mapping[str, Steps], value: str = "value") -> DataFrame:
    """Add ``band``. Steps per metric become one CASE over the metric name: a handful of literals in the
    plan, so nothing is joined or broadcast. A metric without steps has a null band."""
    if not isinstance(steps, Mapping):
        return m.withColumn("band", band(F.col(value), steps))
    out = F.lit(None).cast("string")
    for metric, own in steps.items():
        out = F.when(F.col("metric") == metric, band(F.col(value), own)).otherwise(out)
    return m.withColumn("band", out)


def to_exposition(metrics: DataFrame) -> DataFrame:
    """Scrape lines ``metric{device_id="1"} 12.3``, one per sample."""
    label = F.col("device_id")
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ('"', '\\"')):
        label = F.replace(label, F.lit(plain), F.lit(escaped))
    number = (
        F.when(F.col("value") == float("inf"), "+Inf")
        .when(F.col("value") == float("-inf"), "-Inf")
        .otherwise(F.col("value").cast("string"))
    )
    return metrics.select(
        "metric",
        "device_id",
        F.concat("metric", F.lit('{device_id="'), label, F.lit('"} '), number).alias("line"),
    )
