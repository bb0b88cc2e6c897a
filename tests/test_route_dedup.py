from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions.checks import valid_range
from millrace.operators.dedup import dedup_bounded, dedup_exact
from millrace.operators.metrics import latest_per_device
from millrace.operators.parse import event_time
from millrace.operators.route import (
    branch_union_check,
    route_branch,
    route_correct,
    route_dataerr,
    route_fail,
)
from millrace.schema import DOCUMENTED_RANGES, READING_SCHEMA

BASE = ("2024-01-01T00:00:00", 1, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, False, "2024-01-01T00:00:00")
POSITION = {name: i for i, name in enumerate(READING_SCHEMA.fieldNames())}


def reading(**changes):
    row = list(BASE)
    for name, value in changes.items():
        row[POSITION[name]] = value
    return tuple(row)


@pytest.mark.parametrize(
    ("field", "inside", "outside"),
    [
        ("sensor1", (0.0, 100.0), (-0.1, 100.1)),
        ("sensor2", (0.0, 100.0), (-0.1, 100.1)),
        ("sensor3", (0.0, 150.0), (-0.1, 150.1)),
        ("motor1", (0.0, 2000.0), (-1.0, 2000.5)),
        ("motor2", (0.0, 1500.0), (-1.0, 1500.5)),
        ("motor3", (0.0, 1800.0), (-1.0, 1800.5)),
        ("DeviceId", (1, 100), (0, 101)),
    ],
)
def test_bounds_are_inclusive(rows, field, inside, outside):
    df = rows([reading(**{field: v}) for v in (*inside, *outside)], READING_SCHEMA)
    assert [r[0] for r in df.select(valid_range()).collect()] == [True, True, False, False]


def test_documented_device_range(rows):
    df = rows([reading(DeviceId=v) for v in (1, 5, 6)], READING_SCHEMA)
    assert [r[0] for r in df.select(valid_range(DOCUMENTED_RANGES)).collect()] == [True, True, False]


def test_failure_wins_over_implausible_values(rows):
    data = [reading(), reading(isFail=True, sensor1=999.0), reading(sensor1=math.inf), reading(isFail=True)]
    df = rows(data, READING_SCHEMA)
    assert [r["branch"] for r in route_branch(df).collect()] == ["data", "fail", "dataerr", "fail"]
    assert (route_fail(df).count(), route_dataerr(df).count(), route_correct(df).count()) == (2, 1, 1)


def test_branches_are_disjoint_and_complete(rows):
    df = rows([reading(sensor1=float(v), isFail=v % 7 == 0) for v in range(0, 200, 3)], READING_SCHEMA)
    parts = [route_fail(df), route_dataerr(df), route_correct(df)]
    assert branch_union_check(df, parts).count() == 0
    lost = branch_union_check(df, parts[1:])
    assert {r["surplus"] for r in lost.collect()} == {1} and lost.count() == parts[0].count()
    twice = branch_union_check(df, [*parts, parts[2]])
    assert {r["surplus"] for r in twice.collect()} == {-1} and twice.count() == parts[2].count()


def test_dedup_keeps_the_earliest_and_ignores_times(rows):
    data = [
        reading(collected_at="2024-01-01T00:00:09"),
        reading(collected_at="garbage"),
        reading(collected_at="2024-01-01T00:00:03", time=None),
        reading(collected_at="2024-01-01T00:00:03", time="2024-01-01T00:00:02"),
        reading(sensor1=1.5, collected_at="2024-01-01T00:00:04"),
    ]
    kept = dedup_exact(event_time(rows(data, READING_SCHEMA))).orderBy("sensor1").collect()
    assert [(r["collected_at"], r["time"]) for r in kept] == [
        ("2024-01-01T00:00:03", "2024-01-01T00:00:02"),
        ("2024-01-01T00:00:04", BASE[0]),
    ]


def test_dedup_is_idempotent_and_commutes_with_routing(rows):
    data = [reading(sensor1=float(v % 13) * 10, isFail=v % 3 == 0) for v in range(200)]
    df = event_time(rows(data, READING_SCHEMA)).repartition(5)
    once = dedup_exact(df)
    assert sorted(dedup_exact(once).collect()) == sorted(once.collect())
    assert sorted(route_dataerr(once).collect()) == sorted(dedup_exact(route_dataerr(df)).collect())
    assert sorted(dedup_bounded(df).collect()) == sorted(once.collect())


def test_hot_copies_shrink_before_the_shuffle(rows, capsys):
    df = rows([reading()], READING_SCHEMA).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    hot = df.crossJoin(rows([(i,) for i in range(3)], "i int")).drop("i")
    dedup_exact(hot).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("Exchange")[-1]


def test_latest_puts_null_times_last_and_settles_ties(rows):
    data = [
        reading(time=None, sensor1=9.0),
        reading(time="2024-01-01T00:00:05", sensor1=2.0, collected_at="a"),
        reading(time="2024-01-01T00:00:05", sensor1=3.0, collected_at="b"),
        reading(DeviceId=2, time=None, sensor1=7.0),
    ]
    df = rows(data, READING_SCHEMA).repartition(4)
    found = {r["DeviceId"]: r["sensor1"] for r in latest_per_device(df).collect()}
    assert found == {1: 3.0, 2: 7.0}
