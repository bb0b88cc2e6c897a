from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from millrace.operators.clean import clock_skew_check, drop_incomplete, label_regex_filter, strict_reject
from millrace.operators.parse import (
    encode_records,
    event_time,
    json_valid_records,
    parse_reading,
    stamp_collected_at,
    time_partitions,
    value_as_string,
    zero_pad_partitions,
)
from millrace.schema import MEASURES, READING_SCHEMA

GOOD = {
    "time": "2024-01-01T00:00:00", "DeviceId": 1, "sensor1": 1.0, "sensor2": 2.0, "sensor3": 3.0,
    "motor1": 4.0, "motor2": 5.0, "motor3": 6.0, "isFail": False, "collected_at": "2024-01-01T00:00:01.000002",
}


def variant(**changes) -> str:
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "absent"})


def parse_one(rows, value, **options):
    return parse_reading(rows([(value,)], "value string"), **options).collect()


@pytest.mark.parametrize(
    "value",
    [None, "", "{", '{"DeviceId":', "[1, 2]", '[{"DeviceId": 1}]' + "x", "not json"],
)
def test_what_does_not_decode_is_all_null_and_dropped(rows, value):
    df = rows([(value,)], "value string")
    parsed = parse_reading(df)
    assert parsed.columns == READING_SCHEMA.fieldNames()
    assert all(v is None for v in parsed.first())
    assert drop_incomplete(parsed).count() == 0


@pytest.mark.parametrize(
    ("value", "field"),
    [
        (variant(sensor1="1.5"), "sensor1"),
        (variant(DeviceId=1.5), "DeviceId"),
        (variant(DeviceId="1"), "DeviceId"),
        (variant(isFail="false"), "isFail"),
        (json.dumps({**{k: v for k, v in GOOD.items() if k != "sensor1"}, "Sensor1": 1.0}), "sensor1"),
        (variant(motor2=None), "motor2"),
        (variant(collected_at="absent"), "collected_at"),
    ],
)
def test_field_of_wrong_type_or_case_is_null_and_the_row_dropped(rows, value, field):
    parsed = parse_reading(rows([(value,)], "value string"))
    row = parsed.first()
    assert row[field] is None
    assert drop_incomplete(parsed).count() == 0


def test_coerce_reads_numbers_and_flags_given_as_text(rows):
    row = parse_one(rows, variant(sensor1="1.5", DeviceId="7", isFail="true"), coerce=True)[0]
    assert (row["sensor1"], row["DeviceId"], row["isFail"], row["motor1"]) == (1.5, 7, True, 4.0)
    bad = parse_one(rows, variant(sensor1="warm"), coerce=True)[0]
    assert bad["sensor1"] is None and bad["sensor2"] == 2.0


def test_junk_behind_a_whole_object_and_extra_fields_are_accepted(rows):
    for value in (variant() + " junk", variant(extra={"a": [1]})):
        row = parse_one(rows, value)[0]
        assert row["DeviceId"] == 1 and row["collected_at"] == GOOD["collected_at"]


def test_nan_is_dropped_infinity_stays(rows):
    nan = parse_reading(rows([(variant(sensor1=math.nan),)], "value string"))
    assert math.isnan(nan.first()["sensor1"]) and drop_incomplete(nan).count() == 0
    inf = parse_reading(rows([(variant(sensor1=math.inf),)], "value string"))
    assert drop_incomplete(inf).first()["sensor1"] == math.inf


def test_null_time_is_not_required(rows):
    kept = drop_incomplete(parse_reading(rows([(variant(time=None),)], "value string")))
    assert kept.first()["time"] is None


def test_record_is_parsed_once_however_many_fields_are_filtered(rows, capsys):
    drop_incomplete(parse_reading(rows([(variant(),)], "value string"))).explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_bytes_round_trip(rows):
    df = rows([("é{}".encode(),)], "value binary")
    assert value_as_string(df).first()["value"] == "é{}"


def test_encode_then_parse_gives_the_record_back(rows):
    record = parse_reading(rows([(variant(),), (variant(time=None, DeviceId=5),)], "value string"))
    encoded = encode_records(record)
    assert [r["key"] for r in encoded.collect()] == ["1", "5"]
    assert "time" not in json.loads(encoded.collect()[1]["value"])
    assert parse_reading(encoded).collect() == record.collect()


JSON_CASES = [
    '{"a":1}', '{"a":1} x', '{"a":NaN}', "", " ", "null", " null ", "[1]", '{"a":1,"a":2}', '{"a":Infinity}',
    '{"DeviceId":', "{'a':1}", "01", '"s"', '{"a":1}{"b":2}', "1],[2", "1},{", "1,2", '{"a":1},{"b":2}',
    '{"a":"x\ty"}', "true", "nul", "1.5", '{"a":+1}', '{"a":1}]', '{"a":1}}', "{a:1}", '{"a":1,}', "[1,]",
    '{"a":{"b":[1,{"c":NaN}]}}', "-", "1e5", '"\\u00e9"', None, "NaN", "-Infinity", "INF", '{"a":.5}', '{"a":5.}',
    '{"a":/*c*/1}', '{"a":"\\x"}', "1 2", '1,"k":2', '1,"k"', '1,"k"]', "﻿{}",
]


def test_json_valid_records_accepts_what_a_json_decoder_accepts(rows):
    def decodes(text):
        try:
            json.loads(text)
            return True
        except (TypeError, ValueError):
            return False

    kept = json_valid_records(rows([(v,) for v in JSON_CASES], "value string"))
    assert [r["value"] for r in kept.collect()] == [v for v in JSON_CASES if decodes(v)]


def test_event_time_of_bad_text(rows):
    texts = ["2024-01-15T12:30:00.000001", "garbage", "2024-13-01T00:00:00", "2024-01-15", None]
    df = rows([(t,) for t in texts], "collected_at string")
    found = [str(r["t"]) for r in event_time(df).select(F.col("ts").cast("string").alias("t")).collect()]
    assert found == ["2024-01-15 12:30:00.000001", "None", "None", "2024-01-15 00:00:00", "None"]
    assert event_time(df, on_bad_ts="reject").count() == 2
    with pytest.raises(ValueError):
        event_time(df, on_bad_ts="ignore")


def test_partitions_plain_and_padded(rows):
    df = event_time(rows([("2024-07-05T03:04:05",)], "collected_at string"))
    plain = time_partitions(df).first()
    assert (plain["year"], plain["month"], plain["day"], plain["hour"]) == (2024, 7, 5, 3)
    padded = zero_pad_partitions(df).first()
    assert (padded["year"], padded["month"], padded["day"], padded["hour"]) == ("2024", "07", "05", "03")
    assert padded["stamp"] == "20240705_030405"


def test_stamp_collected_at(rows):
    df = rows([(1,)], "DeviceId int")
    stamped = stamp_collected_at(df, F.lit("2024-01-02 03:04:05").cast("timestamp"))
    assert stamped.first()["collected_at"] == "2024-01-02T03:04:05.000000"
    assert len(stamp_collected_at(df).first()["collected_at"]) == 26


def test_strict_reject_names_every_reason(rows):
    cases = {
        variant(): [],
        variant(time=None): ["missing_time"],
        variant(time="yesterday"): ["bad_time_time"],
        variant(collected_at="2024-13-01T00:00:00"): ["bad_time_collected_at"],
        variant(collected_at="2024-01-01"): ["bad_time_collected_at"],
        variant(DeviceId=6): ["out_of_range_DeviceId"],
        variant(DeviceId="x", sensor1="1.5"): ["bad_type_DeviceId"],
        variant(sensor1=100.1, motor3=-1): ["out_of_range_sensor1", "out_of_range_motor3"],
        variant(sensor2=math.nan): ["bad_type_sensor2"],
        variant(motor1="absent", isFail="maybe"): ["missing_motor1", "bad_type_isFail"],
        variant(time=""): ["missing_time"],
    }
    found = strict_reject(rows([(v,) for v in cases], "value string")).collect()
    assert {r["value"]: r["reasons"] for r in found} == cases


def test_clock_skew_tolerance_is_inclusive(rows):
    base = "2024-01-01T00:01:00"
    times = ["2024-01-01T00:00:00", "2024-01-01T00:02:00.000001", "2024-01-01T00:01:30", "bad", None]
    df = rows([(t, base) for t in times], "time string, collected_at string")
    assert [r["skewed"] for r in clock_skew_check(df).collect()] == [False, True, False, None, None]


def test_label_regex_covers_the_whole_value(rows):
    df = rows([("1",), ("11",), ("2",), ("x\n1",)], "device_id string")
    assert [r[0] for r in label_regex_filter(df, "device_id", "1|2").collect()] == ["1", "2"]
    assert label_regex_filter(df, "device_id").count() == 4


def test_measures_are_schema_fields():
    assert set(MEASURES) < set(READING_SCHEMA.fieldNames())


def test_a_time_without_a_date_is_no_time(rows):
    df = rows([("12:30:00",), ("T12:30",), ("2024-01-01",), (" 2024-01-01T01:00:00",), (None,)], "collected_at string")
    assert [r["ts"] is None for r in event_time(df).collect()] == [True, True, False, False, True]
