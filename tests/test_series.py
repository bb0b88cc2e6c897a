from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.clock import micros
from millrace.operators.metrics import (
    SERIES,
    device_count,
    error_count_per_device,
    hourly_branch_counts,
    label_values,
    legend_reduce,
    legend_sort,
    metric_ratio_join,
    threshold_band,
    to_exposition,
    to_metrics,
)
from millrace.operators.series import (
    avg_over_time,
    counter_increase,
    counter_increase_grid,
    evaluations,
    instant_value,
    instant_value_at,
    instant_value_at_times,
    time_reversal,
)
from millrace.schema import GAUGE_STEPS

T0 = datetime(2024, 1, 1)
METRIC = "metric string, device_id string, ts timestamp, value double"


def sec(s: float) -> datetime:
    return T0 + timedelta(seconds=s)


def samples(seed: int, n: int, span: float, devices: int = 2):
    """Distinct times per series; one series holds most of the samples."""
    rnd = random.Random(seed)
    taken, out = set(), []
    for _ in range(n):
        device = "1" if rnd.random() < 0.7 else str(rnd.randrange(2, devices + 2))
        at = round(rnd.choice([rnd.uniform(0, span), rnd.randrange(int(span))]), 3)
        if (device, at) not in taken:
            taken.add((device, at))
            out.append(("c", device, sec(at), float(rnd.randrange(100))))
    return out


def grown(values):
    return sum(b if b < a else b - a for a, b in zip(values, values[1:]))


@pytest.mark.parametrize(("seed", "n", "span", "window"), [(1, 300, 600, 30), (2, 400, 20, 30), (3, 200, 5000, 90)])
def test_counter_increase_equals_brute_force(rows, seed, n, span, window):
    data = samples(seed, n, span)
    got = counter_increase(rows(data, METRIC), f"{window} seconds").collect()
    series = defaultdict(list)
    for _, device, ts, value in sorted(data, key=lambda r: r[2]):
        series[device].append((ts, value))
    want = {}
    for device, points in series.items():
        for ts, _ in points:
            inside = [v for t, v in points if ts - timedelta(seconds=window) <= t <= ts]
            want[device, ts] = grown(inside) if len(inside) > 1 else None
    assert len(got) == len(want)
    for r in got:
        expected = want[r["device_id"], r["ts"]]
        assert (r["increase"] is None) == (expected is None)
        assert expected is None or r["increase"] == pytest.approx(expected)


def test_counter_restart_counts_from_zero(rows):
    data = [("c", "1", sec(s), v) for s, v in [(0, 5.0), (10, 9.0), (20, 2.0), (60, 4.0)]]
    got = {r["ts"]: r["increase"] for r in counter_increase(rows(data, METRIC)).collect()}
    assert got == {sec(0): None, sec(10): 4.0, sec(20): 6.0, sec(60): None}


def test_small_steps_after_large_totals_are_kept(rows):
    """A running total of 1e17 has no room for 0.5, so growth may not be a difference of totals."""
    data = [("c", "1", sec(60 * i), v) for i, v in enumerate([0.0, 1e17, 0.0, 0.5, 1.0])]
    got = {r["ts"]: r["increase"] for r in counter_increase(rows(data, METRIC), "2 minutes").collect()}
    assert got == {sec(0): None, sec(60): 1e17, sec(120): 1e17, sec(180): 0.5, sec(240): 1.0}
    grid = counter_increase_grid(rows(data, METRIC), "2 minutes", "1 minute").collect()
    assert {r["ts"]: r["increase"] for r in grid} == {sec(60): 1e17, sec(120): 1e17, sec(180): 0.5, sec(240): 1.0, sec(300): 0.5}
    dense = [("c", "1", sec(i), v) for i, v in enumerate([0.0, 1e17, 0.0, 0.5, 1.0, 1.5])]
    got = {r["ts"]: r["increase"] for r in counter_increase(rows(dense, METRIC), "2 seconds").collect()}
    assert got == {sec(0): None, sec(1): 1e17, sec(2): 1e17, sec(3): 0.5, sec(4): 1.0, sec(5): 1.0}


@pytest.mark.parametrize(("window", "step", "bucket"), [(90, 60, 10), (600, 30, 60), (45, 100, 7), (3600, 1800, 60)])
def test_growth_with_many_buckets_equals_brute_force(rows, window, step, bucket):
    data = samples(window, 250, 4000)
    points = defaultdict(list)
    for _, device, ts, value in sorted(data, key=lambda r: r[2]):
        points[device].append((ts, value))

    def want(device, at):
        inside = [v for t, v in points[device] if at - timedelta(seconds=window) <= t <= at]
        return grown(inside) if len(inside) > 1 else None

    names = (f"{window} seconds", f"{step} seconds", f"{bucket} seconds")
    for r in counter_increase(rows(data, METRIC), names[0], bucket=names[2]).collect():
        expected = want(r["device_id"], r["ts"])
        assert r["increase"] == (expected if expected is None else pytest.approx(expected))
    grid = {(r["device_id"], r["ts"]): r["increase"] for r in counter_increase_grid(rows(data, METRIC), *names[:2], bucket=names[2]).collect()}
    zero = datetime(1970, 1, 1)
    first = zero + timedelta(seconds=(T0 - zero).total_seconds() // step * step)
    times = [first + timedelta(seconds=k * step) for k in range(8000 // step + 2)]
    expected = {(d, t): want(d, t) for d in points for t in times}
    assert grid == {k: pytest.approx(v) for k, v in expected.items() if v is not None}


def as_of(data, times, reach):
    """Per time (of a device or of all) the last sample of each series within the look-back."""
    out = set()
    for device, at in times:
        for one in {r[:2] for r in data if device in (None, r[1])}:
            seen = [(t, v) for m, d, t, v in data if (m, d) == one and v is not None and at - timedelta(seconds=reach) <= t <= at]
            if seen:
                out.add((*one, at, *max(seen)))
    return out


@pytest.mark.parametrize(("span", "reach", "width"), [(600, 30, 60), (6000, 400, 60), (300, 5000, 10), (6000, 45, 3600)])
def test_values_at_given_times_equal_brute_force(rows, span, reach, width):
    data = samples(span, 150, span) + [("d", "1", sec(s), v) for s, v in [(3, 1.0), (3, 2.0), (90, None), (90.5, 7.0)]]
    rnd = random.Random(reach)
    at = [sec(rnd.randrange(-100, span + 6000) / 2) for _ in range(120)] + [r[2] for r in data[:10]] + [sec(3), sec(3), sec(1e5)]
    args = (f"{reach} seconds", SERIES, f"{width} seconds")
    all_series = instant_value_at_times(rows(data, METRIC), rows([(t,) for t in at] + [(None,)], "eval_ts timestamp"), *args)
    got = [tuple(r[c] for c in ("metric", "device_id", "eval_ts", "ts", "value")) for r in all_series.collect()]
    assert len(got) == len(set(got)) and set(got) == as_of(data, [(None, t) for t in at], reach)
    per_device = [(rnd.choice("12"), t) for t in at]
    times = rows([(d, t, "other") for d, t in per_device], "device_id string, eval_ts timestamp, value string")
    got = [tuple(r[c] for c in ("metric", "device_id", "eval_ts", "ts", "value")) for r in instant_value_at_times(rows(data, METRIC), times, *args).collect()]
    assert len(got) == len(set(got)) and set(got) == as_of(data, per_device, reach)
    named = rows([("c", d, t) for d, t in per_device], "metric string, device_id string, eval_ts timestamp")
    got = {tuple(r[c] for c in ("metric", "device_id", "eval_ts", "ts", "value")) for r in instant_value_at_times(rows(data, METRIC), named, *args).collect()}
    assert got == {r for r in as_of(data, per_device, reach) if r[0] == "c"}


def test_values_at_times_of_empty_frames(rows):
    times, none = rows([(sec(5),)], "eval_ts timestamp"), rows([], "eval_ts timestamp")
    assert instant_value(rows([], METRIC), times).collect() == []
    assert instant_value(rows([("c", "1", sec(0), 1.0)], METRIC), none).collect() == []
    got = instant_value(rows([("c", "1", sec(0), 1.0)], METRIC), times, until=sec(5)).collect()
    assert [tuple(r) for r in got] == [("c", "1", sec(5), 1.0)]
    assert instant_value(rows([("c", "1", sec(0), 1.0)], METRIC), times, until=sec(4)).collect() == []


def test_values_at_times_put_no_series_into_one_group(rows):
    """Windows go over slices, and over one row per slice; a sample meets no time by a join."""
    df = instant_value_at_times(rows(samples(1, 50, 600), METRIC), rows([("c", "1", sec(5))], "metric string, device_id string, eval_ts timestamp"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 2


@pytest.mark.parametrize("seed", [4, 5])
def test_grid_increase_and_mean_equal_brute_force(rows, seed):
    data = samples(seed, 400, 400)
    got = counter_increase_grid(rows(data, METRIC))
    series = defaultdict(list)
    for _, device, ts, value in sorted(data, key=lambda r: r[2]):
        series[device].append((ts, value))
    want = {}
    for device, points in series.items():
        for k in range(0, 20):
            at = sec(30 * k)
            inside = [v for t, v in points if at - timedelta(seconds=30) <= t <= at]
            if len(inside) > 1:
                want[device, at] = grown(inside)
    assert {(r["device_id"], r["ts"]): r["increase"] for r in got.collect()} == want
    means = {(r["device_id"], r["ts"]): r["mean"] for r in avg_over_time(got).collect()}
    for (device, at), mean in means.items():
        two = [want[k] for k in ((device, at), (device, at - timedelta(seconds=30))) if k in want]
        assert mean == pytest.approx(sum(two) / len(two))
    assert set(means) == set(want) | {(d, t + timedelta(seconds=30)) for d, t in want}


@pytest.mark.parametrize(("every", "back"), [(60, 600), (60, 30), (30, 30)])
def test_evaluations_equal_brute_force(rows, every, back):
    data = samples(6, 60, 6000)
    got = evaluations(rows(data, METRIC), f"{every} seconds", f"{back} seconds").collect()
    series = defaultdict(list)
    for _, device, ts, value in data:
        series[device].append((ts, value))
    want = {}
    for device, points in series.items():
        at = T0
        first = min(t for t, _ in points)
        end = max(t for t, _ in points)
        while at < first:
            at += timedelta(seconds=every)
        last_tick = T0
        while last_tick < end:
            last_tick += timedelta(seconds=every)
        while at <= max(last_tick, end + timedelta(seconds=back)):
            seen = [(t, v) for t, v in points if at - timedelta(seconds=back) <= t <= at]
            want[device, at] = max(seen)[1] if seen else None
            at += timedelta(seconds=every)
    assert {(r["device_id"], r["eval_ts"]): r["value"] for r in got} == want
    known = instant_value(rows(data, METRIC), f"{every} seconds", f"{back} seconds")
    assert known.count() == sum(v is not None for v in want.values())


def test_evaluations_run_on_until_the_given_time(rows):
    df = rows([("c", "1", sec(0), 1.0)], METRIC)
    got = evaluations(df, "1 minute", "2 minutes", until=sec(300)).orderBy("eval_ts").collect()
    assert [r["value"] for r in got] == [1.0, 1.0, 1.0, None, None, None]


def test_instant_value_at(rows):
    data = [("c", "1", sec(0), 1.0), ("c", "1", sec(5), 2.0), ("c", "1", sec(11), 3.0), ("c", "2", sec(-700), 4.0)]
    got = instant_value_at(rows(data, METRIC), sec(10)).collect()
    assert [(r["device_id"], r["value"]) for r in got] == [("1", 2.0)]


def test_time_reversal_across_slices_and_copies(rows):
    def iso(s):
        return sec(s).isoformat()

    # (device, collected at, own time); device 1 has a copy, a gap of many slices and a bad time
    data = [
        (1, 0, 0), (1, 10, 5), (1, 10, 5), (1, 20, 4), (1, 4000, 3), (1, 4001, 30), (1, 4002, None), (1, 4003, 1),
        (2, 3999, 50), (2, 4000, 49),
    ]
    df = rows([(d, iso(c), None if t is None else iso(t)) for d, c, t in data], "DeviceId int, collected_at string, time string")
    df = df.withColumn("ts", F.to_timestamp("collected_at")).unionByName(
        rows([(1, "garbage", iso(-99))], "DeviceId int, collected_at string, time string").withColumn(
            "ts", F.lit(None).cast("timestamp")
        )
    )
    got = time_reversal(df).collect()
    assert len(got) == len(data) + 1
    marked = sorted((r["DeviceId"], r["collected_at"]) for r in got if r["reversed"])
    assert marked == [(1, iso(20)), (1, iso(4000)), (2, iso(4000))]


@pytest.mark.parametrize("seed", [7, 8])
def test_time_reversal_equals_brute_force(rows, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice([1, 1, 1, 2]), rnd.randrange(500), rnd.randrange(500)) for _ in range(400)]
    text = [(d, sec(c).isoformat(), sec(t).isoformat()) for d, c, t in data]
    df = rows(text, "DeviceId int, collected_at string, time string").withColumn("ts", F.to_timestamp("collected_at"))
    latest = defaultdict(dict)
    for d, c, t in data:
        latest[d][c] = max(t, latest[d].get(c, t))
    want = []
    for d, c, t in data:
        earlier = [x for x in latest[d] if x < c]
        want.append((d, c, t, bool(earlier) and t < latest[d][max(earlier)]))
    got = time_reversal(df, slice_width="1 minute").collect()
    back = [(r["DeviceId"], int((r["ts"] - T0).total_seconds()), int((datetime.fromisoformat(r["time"]) - T0).total_seconds()), r["reversed"]) for r in got]
    assert sorted(back) == sorted(want)


def test_metrics_skip_nulls_and_cast(rows):
    df = rows([(1, 1.5, None), (2, None, None)], "DeviceId int, a double, b double")
    got = to_metrics(df, "p_", ("a", "b")).collect()
    assert [tuple(r) for r in got] == [("p_a", "1", 1.5)]


def test_exposition_escapes_labels_and_names_infinity(rows):
    df = rows([("m", 'a"\\\n', 12.0), ("m", "1", float("inf")), ("m", "2", float("nan"))], "metric string, device_id string, value double")
    assert [r["line"] for r in to_exposition(df).collect()] == [
        'm{device_id="a\\"\\\\\\n"} 12.0', 'm{device_id="1"} +Inf', 'm{device_id="2"} NaN',
    ]


def test_legend(rows):
    data = [("a", "1", sec(0), None), ("a", "1", sec(1), 2.0), ("a", "1", sec(2), 4.0), ("a", "1", sec(3), None),
            ("a", "2", sec(1), 9.0)]
    reduced = legend_reduce(rows(data, METRIC))
    got = [(r["device_id"], r["first"], r["mean"], r["last"]) for r in legend_sort(reduced).collect()]
    assert got == [("2", 9.0, 9.0, 9.0), ("1", 2.0, 3.0, 4.0)]
    assert [r[0] for r in label_values(rows(data, METRIC), "a").collect()] == ["1", "2"]


def test_ratio_matches_labels_and_guards_zero(rows):
    data = [("av", "node", "1", sec(0), 25.0), ("to", "node", "1", sec(0), 100.0), ("av", "node", "2", sec(0), 1.0),
            ("to", "node", "3", sec(0), 0.0), ("av", "node", "3", sec(0), 0.0), ("av", "x", "1", sec(0), 9.0)]
    df = rows(data, "metric string, job string, instance string, ts timestamp, value double")
    got = metric_ratio_join(df, "av", "to", ("job", "instance", "ts"), F.col("job") == "node").collect()
    assert sorted((r["instance"], r["value"]) for r in got) == [("1", 75.0), ("3", None)]


def test_bands(rows):
    values = [-0.1, 0.0, 89.9, 90.0, None]
    df = rows([("sensor1", v) for v in values] + [("other", 1.0)], "metric string, value double")
    got = [r["band"] for r in threshold_band(df, GAUGE_STEPS).collect()]
    assert got == ["red", "green", "green", "red", None, None]


def test_error_count_includes_both_ends_and_crosses_the_hour(rows):
    times = [-1, 0, 1800, 3600, 3601]
    df = rows([(1, sec(s)) for s in times], "DeviceId int, ts timestamp")
    got = error_count_per_device(df, sec(3600)).collect()
    assert [(r["DeviceId"], r["error_count"]) for r in got] == [(1, 3)]
    assert device_count(df).first()["devices"] == 5


def test_hourly_counts(rows):
    df = rows([(1, "fail", sec(s)) for s in (0, 3599, 3600)] + [(1, "fail", None)], "DeviceId int, branch string, ts timestamp")
    got = {r["hour_start"]: r["readings"] for r in hourly_branch_counts(df).collect()}
    assert got == {sec(0): 2, sec(3600): 1}


def test_micros():
    assert micros("30 seconds") == 30_000_000 and micros("1 hour") == micros(timedelta(hours=1))


def test_evaluations_end_with_until_amid_the_data(rows):
    df = rows([("m", "1", sec(60 * i), float(i)) for i in range(1, 11)], METRIC)
    got = evaluations(df, "1 minute", "10 minutes", until=sec(300)).orderBy("eval_ts").collect()
    assert [(r["eval_ts"], r["value"]) for r in got] == [(sec(60 * i), float(i)) for i in range(1, 6)]


def test_means_are_on_the_grid(rows):
    df = rows([("m", "1", sec(7), 1.0), ("m", "1", sec(20), 3.0), ("m", "1", sec(37), 5.0)], METRIC.replace("value", "increase"))
    got = avg_over_time(df, "1 minute", "30 seconds").orderBy("ts").collect()
    assert [(r["ts"], r["mean"], r["steps"]) for r in got] == [(sec(30), 3.0, 1), (sec(60), 4.0, 2), (sec(90), 5.0, 1)]
