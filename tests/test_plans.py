"""Physical plans: what must be in them for the jobs to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.operators import metrics, series, words
from millrace.operators.dedup import dedup_exact
from millrace.session import shared_dir
from millrace.sinks.layers import write_layer
from millrace.sources.layers import scan_layer

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name) -> str:
    return plan(contract.queries()[name](spark, SF))


def test_every_scan_reads_only_the_columns_it_needs(spark):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in query_plan(spark, "stamp_collected_at")
    assert "ReadSchema: struct<text:string>" in query_plan(spark, "word_count")
    assert "html" not in query_plan(spark, "word_split_ws")


@pytest.mark.parametrize("name", ["drop_incomplete", "route_dataerr", "dedup_exact", "latest_per_device", "strict_reject"])
def test_records_are_parsed_once(spark, name):
    assert query_plan(spark, name).count("from_json") == 1


@pytest.mark.parametrize("name", ["parse_reading", "route_branch", "strict_reject", "clock_skew_check", "threshold_band"])
def test_row_work_has_no_shuffle(spark, name):
    assert "Exchange" not in query_plan(spark, name)


@pytest.mark.parametrize(("name", "shuffles"), [("branch_counts", 2), ("dedup_exact", 1), ("latest_per_device", 2),
                                                ("metric_ratio_join", 1), ("word_count", 1), ("legend_reduce", 1),
                                                ("branch_union_check", 1), ("is_empty", 0)])
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", query_plan(spark, name))) == shuffles


def test_alert_states_add_one_shuffle_and_one_sort(spark):
    before, after = query_plan(spark, "alert_threshold"), query_plan(spark, "alert_pending_firing")
    assert after.count("Exchange") == before.count("Exchange")
    assert after.count("Sort [") <= before.count("Sort [") + 1


def test_top_one_is_limited_before_the_shuffle(spark):
    got = query_plan(spark, "latest_per_device")
    assert got.count("WindowGroupLimit") >= 4


def test_windows_over_a_device_are_cut_by_time(spark):
    """No window over raw samples is partitioned by device or series alone: those over a series have one row a bucket."""
    for name in ("counter_increase", "counter_increase_grid", "time_reversal"):
        found = re.findall(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]", query_plan(spark, name))
        assert found
        for keys, order in found:
            assert re.search(r"slice|bucket|group", keys) or re.match(r"(bucket|place)#", order), (name, keys, order)


def test_windows_longer_than_a_bucket(spark):
    """A dense series under windows of many buckets, against a rescan of each window."""
    data = [("m", "1", t + 0.5 * (t % 3), float(t * 7 % 50)) for t in range(0, 900, 2)] + [("m", "2", 5000.0, 1.0), ("m", "2", 5400.0, 4.0)]
    m = spark.createDataFrame(data, "metric string, device_id string, at double, value double")
    m = m.select("metric", "device_id", F.timestamp_micros((F.col("at") * 1e6).cast("long")).alias("ts"), "value")

    def growth(values):
        return sum(b if b < a else b - a for a, b in zip(values, values[1:])) if len(values) > 1 else None

    by = {d: [(at, v) for _, e, at, v in data if e == d] for d in ("1", "2")}
    for window in (7, 300, 3600):
        got = series.counter_increase(m, f"{window} seconds", bucket="10 seconds").collect()
        assert len(got) == len(data)
        for r in got:
            at = r["ts"].timestamp()
            assert r["increase"] == growth([v for t, v in by[r["device_id"]] if at - window <= t <= at])
        grid = series.counter_increase_grid(m, f"{window} seconds", "30 seconds", bucket="10 seconds").collect()
        found = {(r["device_id"], r["ts"].timestamp()): r["increase"] for r in grid}
        want = {}
        for d, samples in by.items():
            for at in range(0, 9100, 30):
                value = growth([v for t, v in samples if at - window <= t <= at])
                if value is not None:
                    want[d, float(at)] = value
        assert found == want and len(grid) == len(want)


def test_hot_counts_are_combined_before_the_shuffle(spark, rows):
    df = rows([("a b",)], "value string")
    assert "partial_count" in plan(words.word_count(words.word_split_ws(df)))
    data = rows([(1, "x")], "DeviceId int, branch string").withColumn("ts", F.current_timestamp())
    assert "partial_count" in plan(metrics.hourly_branch_counts(data))
    samples = data.select(F.lit("m").alias("metric"), F.col("branch").alias("device_id"), "ts", F.lit(1.0).alias("value"))
    assert "partial_max" in plan(series.evaluations(samples))


def test_scan_prunes_partitions_and_branch(spark, capsys):
    root = shared_dir(spark, "plan")
    readings = contract.queries()["dedup_exact"](spark, SF).limit(50).withColumn("ts", F.col("ts").cast("timestamp"))
    dated = readings.withColumns({"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts"), "hour": F.hour("ts")})
    write_layer(dated, root, partitions=("branch", "year", "month", "day", "hour"))
    scan_layer(spark, root, "data", "2024-01-02T05:00:00", "2024-01-03").explain("formatted")
    filters = re.search(r"PartitionFilters: \[(.*?)\]\n", capsys.readouterr().out, re.S).group(1)
    assert all(name in filters for name in ("branch", "year", "month", "day", "hour"))


def test_a_hot_device_is_spread_over_tasks(spark):
    """A third of all rows from one device, over an hour: no task gets more than its share of slices."""
    n = 60_000
    ids = spark.range(n)
    device = F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 500)
    ts = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 60_000)
    m = ids.select(F.lit("m").alias("metric"), device.cast("string").alias("device_id"), ts.alias("ts"), F.col("id").cast("double").alias("value"))
    got = series.counter_increase(m, "2 seconds").withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        share = got.filter("device_id = '1'").groupBy("p").count().agg(F.max("count"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert share[1] >= 6 and share[0] < n / 3 / 2


def test_hot_copies_leave_one_row_per_task(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        *[F.lit(1.0).alias(c) for c in ("sensor1", "sensor2", "sensor3", "motor1", "motor2", "motor3")],
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("DeviceId"),
        F.lit(False).alias("isFail"), F.timestamp_seconds(F.col("id")).alias("ts"),
    )
    kept = dedup_exact(df)
    assert kept.count() == 20_001 and kept.filter("DeviceId = 0").first()["ts"].year == 1970


def test_quality_report_reads_and_decodes_messages_once(spark):
    """One scan, and one parser for the text and one for the types; all counts come out of one exchange."""
    df = contract.queries()["quality_report_by_device_hour"](spark, "/root/testdata/sf0.01")
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 and final.count("inline(array(from_json") == 2
    assert final.count("ReusedExchange") >= 1
