"""Alert conditions, their states over time and the messages they give rise to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clock import micros, to_micros
from millrace.operators.metrics import SERIES, metric_ratio_join
from millrace.operators.series import evaluations
from millrace.schema import (
    ALERT_EVERY,
    ALERT_FOR,
    ALERT_KEEP_FIRING,
    ALERT_LOOKBACK,
    MEMORY_ALERT_LIMIT,
)

#: The state of an evaluation that says nothing about the condition.
UNKNOWN = {"none": "NoData", "error": "Error"}

COMPARE = {
    ">": lambda v, limit: v > limit,
    ">=": lambda v, limit: v >= limit,
    "<": lambda v, limit: v < limit,
    "<=": lambda v, limit: v <= limit,
}


def alert_threshold(
    m: DataFrame,
    op: str,
    limit: float,
    every: str = ALERT_EVERY,
    lookback: str = ALERT_LOOKBACK,
    until=None,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """The condition on the last value, for each series and evaluation time; null without a value, and for a value that
    is not a number, of which the condition cannot be told."""
    at = evaluations(m, every, lookback, until, series)
    return at.withColumn("breach", F.when(~F.isnan(F.col("value").cast("double")), COMPARE[op](F.col("value"), limit)))


def alert_states(
    breaches: DataFrame,
    for_: str = ALERT_FOR,
    keep_firing: str = ALERT_KEEP_FIRING,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """State of the alert of each series at each evaluation.

    Pending from the first breach, Firing once the breach has lasted ``for_``; Recovering from the first
    evaluation without a breach until ``keep_firing`` has passed, then Normal; a breach while Recovering is
    Firing at once. Without a value the state is NoData and what was pending or firing is forgotten; so it is with a
    value that is not a number, whose state is Error.

    All windows share one order, so the plan sorts once. A series has one row per evaluation time, a number
    set by the clock and not by the data.
    """
    order = Window.partitionBy(*series).orderBy("eval_ts")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    failed = F.isnan(F.col("value").cast("double")) if "value" in breaches.columns else F.lit(False)
    kind = (
        F.when(failed, "error").when(F.col("breach").isNull(), "none").when(F.col("breach"), "breach").otherwise("calm")
    )
    us = to_micros(F.col("eval_ts"))
    runs = (
        breaches.withColumn("_kind", kind)
        .withColumn("_new", ~F.lag("_kind").over(order).eqNullSafe(F.col("_kind")))
        .withColumn("_since", F.last(F.when(F.col("_new"), us), ignorenulls=True).over(so_far))
        .withColumn("_age", us - F.col("_since"))
    )
    # What switches the alert on or off for good; in between it stays as it was.
    switch = (
        F.when((F.col("_kind") == "breach") & (F.col("_age") >= micros(for_)), True)
        .when((F.col("_kind") == "calm") & (F.col("_age") >= micros(keep_firing)), False)
        .when(F.col("_kind").isin(*UNKNOWN), False)
    )
    on = F.coalesce(F.last("_switch", ignorenulls=True).over(so_far), F.lit(False))
    state = (
        F.when(F.col("_kind") == "none", UNKNOWN["none"])
        .when(F.col("_kind") == "error", UNKNOWN["error"])
        .when((F.col("_kind") == "breach") & F.col("_on"), "Firing")
        .when(F.col("_kind") == "breach", "Pending")
        .when(F.col("_on"), "Recovering")
        .otherwise("Normal")
    )
    return (
        runs.withColumn("_switch", switch)
        .withColumn("_on", on)
        .withColumn("state", state)
        .drop("_kind", "_new", "_since", "_age", "_switch", "_on")
    )


def alert_messages(
    states: DataFrame, summary: str = "limit exceeded", series: Sequence[str] = SERIES
) -> DataFrame:
    """One row per change of state, with a line of text. A series starts out as Normal."""
    order = Window.partitionBy(*series).orderBy("eval_ts")
    changed = states.withColumn(
        "previous", F.coalesce(F.lag("state").over(order), F.lit("Normal"))
    ).filter("previous <> state")
    who = F.concat_ws(" ", *series)
    text = F.concat(F.lit(f"{summary}: "), who, F.lit(" "), "previous", F.lit(" -> "), "state")
    return changed.select(*series, "eval_ts", "previous", "state", "value", text.alias("message"))


def alert_node_memory(
    m: DataFrame,
    avail: str,
    total: str,
    limit: float = MEMORY_ALERT_LIMIT,
    every: str = ALERT_EVERY,
    lookback: str = ALERT_LOOKBACK,
    for_: str = ALERT_FOR,
    keep_firing: str = ALERT_KEEP_FIRING,
    labels: Sequence[str] = ("job", "instance"),
    where=None,
    until=None,
) -> DataFrame:
    """States of the memory alert: used share in percent above the limit."""
    used = metric_ratio_join(m, avail, total, [*labels, "ts"], where)
    breaches = alert_threshold(used, ">", limit, every, lookback, until, series=labels)
    return alert_states(breaches, for_, keep_firing, series=labels)
