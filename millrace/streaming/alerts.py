"""Alert states on a stream, of evaluations or of the samples themselves."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.clock import ceil_to, from_micros, micros, to_micros
from millrace.operators.alerts import COMPARE, UNKNOWN
from millrace.operators.metrics import SERIES
from millrace.schema import ALERT_EVERY, ALERT_FOR, ALERT_KEEP_FIRING, ALERT_LOOKBACK


def spell_states(kinds: np.ndarray, at: np.ndarray, memory: tuple, hold: int, keep: int) -> tuple[list[str], tuple]:
    """States after evaluations in order; ``memory`` is (kind of the running spell, its start, alert on).

    Evaluations of one kind in a row are a spell: there the alert turns on or off at most once, at an age. So the
    spells are gone through, not the evaluations.
    """
    states = np.empty(len(kinds), dtype=object)
    heads = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    last, since, on = memory
    for lo, hi in zip(heads, [*heads[1:], len(kinds)]):
        kind = kinds[lo]
        since = since if kind == last else int(at[lo])
        age = at[lo:hi] - since
        if kind in UNKNOWN:
            states[lo:hi], on = UNKNOWN[kind], False
        elif kind == "breach":
            firing = on | (age >= hold)
            states[lo:hi] = np.where(firing, "Firing", "Pending")
            on = bool(firing[-1])
        else:
            kept = on & (age < keep)
            states[lo:hi] = np.where(kept, "Recovering", "Normal")
            on = bool(kept[-1])
        last = str(kind)
    return list(states), (last, since, on)


def stream_alert_states(
    breaches: DataFrame,
    for_: str = ALERT_FOR,
    keep_firing: str = ALERT_KEEP_FIRING,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """The states of :func:`millrace.operators.alerts.alert_states` as evaluations arrive.

    ``breaches`` has the series columns, ``eval_ts``, ``value`` and ``breach``. Per series four values are
    kept between batches; evaluations of a batch are put in order. One older than the last seen comes too late for
    a state; it is passed on with the state ``Late``, so that it can be counted. Bound the batches at the source:
    the evaluations of a series in one batch are put in order in memory.
    """
    hold, keep = micros(for_), micros(keep_firing)

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        kind, since, on, seen = state.get if state.exists else ("", 0, False, -(2**63))
        rows = pd.concat(list(frames)).sort_values("eval_ts")
        at = rows["eval_ts"].astype("datetime64[us]").astype("int64")
        at = at.to_numpy()
        late = at <= seen
        breach = rows["breach"].astype("boolean")
        over = breach.fillna(False).to_numpy(dtype=bool)
        spell = np.select([rows["failed"].to_numpy(dtype=bool), breach.isna().to_numpy(), over], ["error", "none", "breach"], "calm")
        states = np.full(len(rows), "Late", dtype=object)
        if not late.all():
            found, memory = spell_states(spell[~late], at[~late], (kind, since, on), hold, keep)
            states[~late] = found
            state.update((*memory, int(at[-1])))
        if len(rows):
            yield rows.assign(state=states)[[*series, "eval_ts", "value", "breach", "state"]]

    failed = F.coalesce(F.isnan(F.col("value").cast("double")), F.lit(False))
    picked = breaches.select(*series, "eval_ts", "value", "breach")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema)
    told = picked.withColumn("failed", failed).groupBy(*series).applyInPandasWithState(
        advance,
        f"{kinds}, state string",
        "kind string, since long, on boolean, seen long",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    # what is no number is null to the frames above
    return told.withColumn("value", F.when(F.col("state") == UNKNOWN["error"], float("nan")).otherwise(F.col("value")))


#: A time before all samples.
NEVER = -(2**62)


def _last_per_tick(series: Sequence[str]):
    """The last sample of each series and evaluation interval in an Arrow batch, ahead of the shuffle."""
    keys = [*series, "tick"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).sort_by([("us", "ascending"), ("value", "ascending")])
            last = rows.group_by(keys, use_threads=False).aggregate([("us", "last"), ("value", "last")])
            yield from last.select([*keys, "us_last", "value_last"]).rename_columns([*keys, "us", "value"]).to_batches()

    return run


#: Per series: intervals that are not evaluated yet, with the time and value of their last sample; the next evaluation;
#: the last sample before it; and the kind of the running spell, its start and whether the alert is on.
_MEMORY = (
    "ticks array<long>, times array<long>, values array<double>, next long, last_us long, last_value double, "
    "kind string, since long, on boolean"
)


def stream_alerts(
    samples: DataFrame,
    op: str,
    limit: float,
    every: str = ALERT_EVERY,
    lookback: str = ALERT_LOOKBACK,
    for_: str = ALERT_FOR,
    keep_firing: str = ALERT_KEEP_FIRING,
    delay: str = "10 minutes",
    forget: str | None = None,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Evaluations and alert states of a stream of samples: the series, ``eval_ts``, ``value``, ``breach``, ``state``.

    Each series is evaluated at all multiples of ``every`` from its first sample on that the watermark, ``delay`` behind
    the latest sample of any series, has passed. A timer wakes up a series of which no sample has come, so that one
    that falls silent leaves its look-back, reports NoData and ends its hold without a further row; after ``forget`` without
    a value it is forgotten, and begins anew with its next sample. Without ``forget`` it reports NoData for ever. A
    sample that is not a number makes the evaluation fail: its state is Error, and like NoData it ends what was pending
    or firing. Equal to the batch form, :func:`millrace.operators.alerts.alert_states`, up to the watermark. Samples
    later than ``delay`` are dropped and counted in the progress.

    Samples shrink to one per series and interval within their task, before the shuffle; so a batch holds of a series
    as many rows as tasks and ticks of the clock, and the state as many as there are ticks in ``delay``. A series that
    was silent is evaluated for all the time gone by, a row per tick.
    """
    step, reach, hold, keep = micros(every), micros(lookback), micros(for_), micros(keep_firing)
    rest = None if forget is None else reach + micros(forget)

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [], [], None, None, None, "", 0, False)
        ticks, times, values, upcoming, last_us, last_value, *memory = held
        pending = {t: (u, v) for t, u, v in zip(ticks, times, values)}
        for frame in frames:
            for t, u, v in zip(frame["tick"].tolist(), frame["us"].tolist(), frame["value"].tolist()):
                if t not in pending or (u, v != v, v) > (pending[t][0], pending[t][1] != pending[t][1], pending[t][1]):
                    pending[t] = (u, v)
        if upcoming is None and not pending:
            return
        at = np.array(sorted(pending), dtype=np.int64)
        upcoming = int(at[0]) if upcoming is None else upcoming
        passed = state.getCurrentWatermarkMs() * 1000
        end = passed // step * step
        known = at[at <= end]
        # with the sample from before, so that each evaluation finds the latest one
        us = np.array([NEVER if last_us is None else last_us, *(pending[t][0] for t in known.tolist())], dtype=np.int64)
        value = np.array([np.nan if last_us is None else last_value, *(pending[t][1] for t in known.tolist())], dtype=float)
        if upcoming <= end:
            grid = np.arange(upcoming, end + 1, step)
            found = np.searchsorted(known, grid, "right")
            fresh = grid - us[found] <= reach
            failed = fresh & np.isnan(value[found])
            with np.errstate(invalid="ignore"):
                over = COMPARE[op](value[found], limit)
            kinds = np.select([~fresh, failed, over], ["none", "error", "breach"], "calm")
            states, memory = spell_states(kinds, grid, tuple(memory), hold, keep)
            sure = fresh & ~failed
            told = pd.DataFrame(
                {
                    **{name: [part] * len(grid) for name, part in zip(series, key)},
                    "eval_ts": pd.to_datetime(grid, unit="us"),
                    "value": pd.arrays.FloatingArray(np.where(sure, value[found], 0.0), ~sure),
                    "breach": pd.arrays.BooleanArray(over, ~sure),
                    "state": states,
                }
            )
            yield told if rest is None else told[grid - us[found] <= rest]
            upcoming = int(grid[-1]) + step
        waiting = at[at > end].tolist()
        gone = int(us[-1]) == NEVER
        if rest is not None and not gone and int(us[-1]) + rest < upcoming:
            if not waiting:
                state.remove()
                return
            upcoming, gone, memory = waiting[0], True, ("", 0, False)
        state.update(
            (
                waiting,
                [pending[t][0] for t in waiting],
                [float(pending[t][1]) for t in waiting],
                upcoming,
                None if gone else int(us[-1]),
                None if gone else float(value[-1]),
                *memory,
            )
        )
        state.setTimeoutTimestamp(max(upcoming // 1000 - 1, state.getCurrentWatermarkMs()))

    us = to_micros(F.col("ts").cast("timestamp"))
    rows = samples.filter("ts IS NOT NULL AND value IS NOT NULL")
    rows = rows.select(*series, ceil_to(us, step).alias("tick"), us.alias("us"), F.col("value").cast("double").alias("value"))
    melted = rows.mapInArrow(_last_per_tick(series), rows.schema).withColumn("seen", from_micros(F.col("us")))
    kinds = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in series)
    return melted.withWatermark("seen", delay).groupBy(*series).applyInPandasWithState(
        advance,
        f"{kinds}, eval_ts timestamp, value double, breach boolean, state string",
        _MEMORY,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    ).withColumn("value", F.when(F.col("state") == UNKNOWN["error"], float("nan")).otherwise(F.col("value")))
