"""Parsing, cleaning, routing, deduplication and quality over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.checks import valid_range
from millrace.operators import clean, dedup, metrics, parse, quality, route, series
from millrace.plans import monitors
from millrace.plans.readings import (
    complete_readings,
    distinct_layers,
    event_messages,
    event_readings,
    labelled_readings,
)
from millrace.plans.registry import (
    CLEANED,
    FIELDS,
    ISO,
    LAGGING,
    MEASURED,
    MESSAGES,
    READINGS,
    TO_LAYERS,
    VALID,
    query,
    table,
    with_,
)
from millrace.schema import MEASURES, READING_SCHEMA
from millrace.session import shared_dir

ID = ("event_id", "copy")
AS_OF = "2024-01-15 12:30:00"


def messages(spark: SparkSession, sf_dir: str, lagging: bool = False) -> DataFrame:
    return event_messages(table(spark, sf_dir, "events"), lagging)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_readings(messages(spark, sf_dir), keep=ID)


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_layers(messages(spark, sf_dir))


@query(
    "branch_counts",
    with_(*TO_LAYERS, body="SELECT branch, count(*) AS readings FROM layers GROUP BY branch"),
)
def branch_counts(spark, sf_dir):
    return metrics.branch_counts(layers(spark, sf_dir))


@query("value_as_string", "SELECT props AS value FROM events")
def value_as_string(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return parse.value_as_string(events.select(F.col("props").cast("binary").alias("value")))


_PARSED = ", ".join(f"CASE WHEN NOT cut_off THEN {f} END AS {f}" for f in FIELDS.split(", "))


@query(
    "parse_reading",
    with_(READINGS, MESSAGES, body=f"SELECT event_id, copy, {_PARSED} FROM messages"),
)
def parse_reading(spark, sf_dir):
    return parse.parse_reading(messages(spark, sf_dir), keep=ID)


@query(
    "parse_reading_coerce",
    with_(
        READINGS,
        body=f"""SELECT event_id, time, CASE WHEN event_id % 13 <> 0 THEN DeviceId END AS DeviceId,
                        {MEASURED}, isFail, collected_at FROM readings""",
    ),
)
def parse_reading_coerce(spark, sf_dir):
    readings = event_readings(table(spark, sf_dir, "events"))
    quoted = {name: F.col(name).cast("string") for name in READING_SCHEMA.fieldNames()}
    quoted["DeviceId"] = F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(quoted["DeviceId"])
    text = readings.select("event_id", F.to_json(F.struct(*[c.alias(n) for n, c in quoted.items()])).alias("value"))
    return parse.parse_reading(text, coerce=True, keep=["event_id"])


@query(
    "json_valid_records",
    with_(
        READINGS,
        MESSAGES,
        body="SELECT event_id, copy FROM messages WHERE NOT cut_off AND event_id % 17 <> 0",
    ),
)
def json_valid_records(spark, sf_dir):
    value = F.when(F.col("event_id") % 17 == 0, F.concat("value", F.lit(" x"))).otherwise(F.col("value"))
    return parse.json_valid_records(messages(spark, sf_dir).withColumn("value", value)).select(*ID)


@query("stamp_collected_at", f"SELECT event_id, strftime(ts, {ISO}) AS collected_at FROM events")
def stamp_collected_at(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return parse.stamp_collected_at(events, F.col("ts").cast("timestamp")).select("event_id", "collected_at")


@query(
    "event_time",
    with_(READINGS, body="SELECT event_id, TRY_CAST(collected_at AS TIMESTAMP) AS ts FROM readings"),
)
def event_time(spark, sf_dir):
    return parse.event_time(event_readings(table(spark, sf_dir, "events"))).select("event_id", "ts")


@query(
    "time_partitions",
    with_(
        READINGS,
        body="""SELECT event_id, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
                       CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour
                FROM (SELECT event_id, TRY_CAST(collected_at AS TIMESTAMP) AS t FROM readings)""",
    ),
)
def time_partitions(spark, sf_dir):
    rows = parse.event_time(event_readings(table(spark, sf_dir, "events")))
    return parse.time_partitions(rows).select("event_id", "year", "month", "day", "hour")


@query(
    "zero_pad_partitions",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
              strftime(ts, '%H') AS hour, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
)
def zero_pad_partitions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"))
    return parse.zero_pad_partitions(events).drop("ts")


@query("project_metrics", with_(READINGS, body=f"SELECT DeviceId, {MEASURED} FROM readings"))
def project_metrics(spark, sf_dir):
    return parse.project_metrics(event_readings(table(spark, sf_dir, "events")))


@query(
    "encode_kafka_record",
    with_(READINGS, body=f"SELECT CAST(DeviceId AS VARCHAR) AS key, {FIELDS} FROM readings"),
)
def encode_kafka_record(spark, sf_dir):
    """Round trip: encoded as key and JSON value, then decoded again."""
    readings = event_readings(table(spark, sf_dir, "events")).drop("event_id")
    return parse.parse_reading(parse.encode_records(readings), keep=["key"])


@query(
    "drop_incomplete",
    with_(
        READINGS,
        MESSAGES,
        body=f"""SELECT event_id, copy, {FIELDS} FROM messages WHERE NOT cut_off AND sensor1 IS NOT NULL
                 AND sensor2 IS NOT NULL AND sensor3 IS NOT NULL AND motor1 IS NOT NULL AND motor2 IS NOT NULL
                 AND motor3 IS NOT NULL AND isFail IS NOT NULL AND DeviceId IS NOT NULL
                 AND collected_at IS NOT NULL""",
    ),
)
def drop_incomplete(spark, sf_dir):
    return clean.drop_incomplete(parse.parse_reading(messages(spark, sf_dir), keep=ID))


@query("valid_range", with_(READINGS, body=f"SELECT event_id, {VALID} AS valid FROM readings"))
def valid_range_(spark, sf_dir):
    readings = event_readings(table(spark, sf_dir, "events"))
    return readings.select("event_id", valid_range().alias("valid"))


def _routed(branch: str) -> str:
    return with_(
        READINGS,
        MESSAGES,
        CLEANED,
        body=f"SELECT event_id, copy, {FIELDS} FROM cleaned WHERE branch = '{branch}'",
    )


@query("route_fail", _routed("fail"))
def route_fail(spark, sf_dir):
    return route.route_fail(drop_incomplete(spark, sf_dir))


@query("route_dataerr", _routed("dataerr"))
def route_dataerr(spark, sf_dir):
    return route.route_dataerr(drop_incomplete(spark, sf_dir))


@query("route_correct", _routed("data"))
def route_correct(spark, sf_dir):
    return route.route_correct(drop_incomplete(spark, sf_dir))


@query(
    "route_branch",
    with_(READINGS, MESSAGES, CLEANED, body="SELECT event_id, copy, branch FROM cleaned"),
)
def route_branch(spark, sf_dir):
    return route.route_branch(drop_incomplete(spark, sf_dir)).select(*ID, "branch")


@query(
    "branch_union_check",
    with_(
        *TO_LAYERS,
        body="""SELECT 'all_parts' AS checked, CAST(0 AS BIGINT) AS violations, CAST(0 AS BIGINT) AS surplus
                UNION ALL
                SELECT 'data_missing', count(*), count(*) FROM layers WHERE branch = 'data'
                UNION ALL
                SELECT 'fail_twice', count(*), -count(*) FROM layers WHERE branch = 'fail'""",
    ),
)
def branch_union_check(spark, sf_dir):
    path = shared_dir(spark, "raw")
    layers(spark, sf_dir).write.parquet(path)
    raw = spark.read.parquet(path)
    parts = {"fail": route.route_fail(raw), "dataerr": route.route_dataerr(raw), "data": route.route_correct(raw)}
    cases = {
        "all_parts": ["fail", "dataerr", "data"],
        "data_missing": ["fail", "dataerr"],
        "fail_twice": ["fail", "fail", "dataerr", "data"],
    }
    return route.branch_union_cases(raw, parts, cases)


_LAYER_ROWS = f"SELECT {FIELDS}, ts, branch FROM layers"


@query("dedup_exact", with_(*TO_LAYERS, body=_LAYER_ROWS))
def dedup_exact(spark, sf_dir):
    rows = dedup.dedup_exact(complete_readings(messages(spark, sf_dir)))
    return route.route_branch(rows)


@query(
    "trailing_window",
    with_(
        *TO_LAYERS,
        body=f"""SELECT {FIELDS}, ts, branch FROM layers
                 WHERE ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND TIMESTAMP '{AS_OF}'""",
    ),
)
def trailing_window(spark, sf_dir):
    rows = route.route_branch(dedup.dedup_exact(complete_readings(messages(spark, sf_dir))))
    return clean.trailing_window(rows, "ts", AS_OF)


@query(
    "strict_reject",
    with_(
        READINGS,
        MESSAGES,
        body="""SELECT event_id, copy, concat_ws(',',
          CASE WHEN cut_off OR time IS NULL THEN 'missing_time' END,
          CASE WHEN cut_off THEN 'missing_DeviceId' END,
          CASE WHEN NOT cut_off AND DeviceId NOT BETWEEN 1 AND 5 THEN 'out_of_range_DeviceId' END,
          CASE WHEN cut_off OR sensor1 IS NULL THEN 'missing_sensor1' END,
          CASE WHEN NOT cut_off AND sensor1 NOT BETWEEN 0 AND 100 THEN 'out_of_range_sensor1' END,
          CASE WHEN cut_off THEN 'missing_sensor2' END,
          CASE WHEN NOT cut_off AND sensor2 NOT BETWEEN 0 AND 100 THEN 'out_of_range_sensor2' END,
          CASE WHEN cut_off THEN 'missing_sensor3' END,
          CASE WHEN NOT cut_off AND sensor3 NOT BETWEEN 0 AND 150 THEN 'out_of_range_sensor3' END,
          CASE WHEN cut_off THEN 'missing_motor1' END,
          CASE WHEN NOT cut_off AND motor1 NOT BETWEEN 0 AND 2000 THEN 'out_of_range_motor1' END,
          CASE WHEN cut_off THEN 'missing_motor2' END,
          CASE WHEN NOT cut_off AND motor2 NOT BETWEEN 0 AND 1500 THEN 'out_of_range_motor2' END,
          CASE WHEN cut_off THEN 'missing_motor3' END,
          CASE WHEN NOT cut_off AND motor3 NOT BETWEEN 0 AND 1800 THEN 'out_of_range_motor3' END,
          CASE WHEN cut_off THEN 'missing_isFail' END,
          CASE WHEN cut_off THEN 'missing_collected_at' END,
          CASE WHEN NOT cut_off AND collected_at = 'garbage' THEN 'bad_time_collected_at' END) AS reasons
        FROM messages""",
    ),
)
def strict_reject(spark, sf_dir):
    verdicts = clean.strict_reject(messages(spark, sf_dir), keep=ID)
    return verdicts.select(*ID, F.array_join("reasons", ",").alias("reasons"))


@query(
    "clock_skew_check",
    with_(
        LAGGING,
        body="""SELECT event_id, abs(epoch_us(TRY_CAST(time AS TIMESTAMP)) - epoch_us(TRY_CAST(collected_at AS TIMESTAMP)))
                       > 60000000 AS skewed FROM readings""",
    ),
)
def clock_skew_check(spark, sf_dir):
    readings = event_readings(table(spark, sf_dir, "events"), device_clock_lag=True)
    return clean.clock_skew_check(readings).select("event_id", "skewed")


_REVERSALS = """arrivals AS (
  SELECT DeviceId, ts, max(TRY_CAST(time AS TIMESTAMP)) AS seen
  FROM dated WHERE ts IS NOT NULL GROUP BY ALL),
previous AS (
  SELECT DeviceId, ts, lag(seen) OVER (PARTITION BY DeviceId ORDER BY ts) AS previous_time FROM arrivals)"""


@query(
    "time_reversal",
    with_(
        LAGGING,
        "dated AS (SELECT *, TRY_CAST(collected_at AS TIMESTAMP) AS ts FROM readings)",
        _REVERSALS,
        body="""SELECT event_id, previous_time,
                       coalesce(TRY_CAST(time AS TIMESTAMP) < previous_time, false) AS reversed
                FROM dated LEFT JOIN previous USING (DeviceId, ts)""",
    ),
)
def time_reversal(spark, sf_dir):
    readings = parse.event_time(event_readings(table(spark, sf_dir, "events"), device_clock_lag=True))
    return series.time_reversal(readings).select("event_id", "previous_time", "reversed")


def _quality_sql(by: str) -> str:
    cols = f"{by}, " if by else ""
    keyed = "GROUP BY ALL" if by else ""
    where = "DeviceId, CAST(hour(ts) AS INTEGER) AS hour, " if by else ""
    return with_(
        LAGGING,
        MESSAGES,
        f"""dated AS (
  SELECT * REPLACE (CASE WHEN event_id % 173 <> 0 THEN sensor2 END AS sensor2) FROM (
    SELECT event_id, copy, cut_off, CASE WHEN NOT cut_off THEN TRY_CAST(collected_at AS TIMESTAMP) END AS ts,
           {_PARSED} FROM messages))""",
        f"""judged AS (
  SELECT {where}
         cut_off OR time IS NULL OR sensor1 IS NULL AS missing,
         NOT cut_off AND collected_at = 'garbage' AS bad_time,
         NOT cut_off AND event_id % 173 = 0 AS type_mismatch,
         NOT cut_off AND coalesce(NOT (sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150
            AND motor1 BETWEEN 0 AND 2000 AND motor2 BETWEEN 0 AND 1500 AND motor3 BETWEEN 0 AND 1800), NOT (sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150
            AND motor1 BETWEEN 0 AND 2000 AND motor2 BETWEEN 0 AND 1500 AND motor3 BETWEEN 0 AND 1800)) AS out_of_range,
         NOT cut_off AND DeviceId NOT BETWEEN 1 AND 5 AS wrong_device
  FROM dated)""",
        "typed AS (SELECT * FROM dated WHERE NOT cut_off AND sensor1 IS NOT NULL AND sensor2 IS NOT NULL)",
        f"""copies AS (
  SELECT {where} sensor1, sensor2, sensor3, motor1, motor2, motor3, isFail, {'' if by else 'DeviceId,'}
         count(*) AS n FROM typed GROUP BY ALL)""",
        _REVERSALS.replace("FROM dated", "FROM typed"),
        f"""turned AS (
  SELECT {where.replace('DeviceId', 't.DeviceId').replace('hour(ts)', 'hour(t.ts)')}
         coalesce(TRY_CAST(t.time AS TIMESTAMP) < p.previous_time, false) AS reversed
  FROM typed t LEFT JOIN previous p ON t.DeviceId = p.DeviceId AND t.ts = p.ts)""",
        body=f"""SELECT {cols} 'missing' AS issue, CAST(count(*) FILTER (missing) AS BIGINT) AS messages FROM judged {keyed}
UNION ALL SELECT {cols} 'bad_time', count(*) FILTER (bad_time) FROM judged {keyed}
UNION ALL SELECT {cols} 'type_mismatch', count(*) FILTER (type_mismatch) FROM judged {keyed}
UNION ALL SELECT {cols} 'out_of_range', count(*) FILTER (out_of_range) FROM judged {keyed}
UNION ALL SELECT {cols} 'wrong_device', count(*) FILTER (wrong_device) FROM judged {keyed}
UNION ALL SELECT {cols} 'duplicate', CAST(sum(n - 1) AS BIGINT) FROM copies {keyed}
UNION ALL SELECT {cols} 'time_reversal', count(*) FILTER (reversed) FROM turned {keyed}""",
    )


def mistyped(messages: DataFrame) -> DataFrame:
    """Messages of which some have text in place of a number."""
    wrong = F.regexp_replace("value", '"sensor2":[^,}]*', '"sensor2":"n/a"')
    return messages.withColumn("value", F.when(F.col("event_id") % 173 == 0, wrong).otherwise(F.col("value")))


@query("quality_report", _quality_sql(""))
def quality_report(spark, sf_dir):
    return quality.quality_report(mistyped(messages(spark, sf_dir, lagging=True)))


@query("quality_report_by_device_hour", _quality_sql("DeviceId, hour"))
def quality_report_by_device_hour(spark, sf_dir):
    return quality.quality_report(mistyped(messages(spark, sf_dir, lagging=True)), by=("DeviceId", "hour"))


_LATEST = f"""latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY DeviceId ORDER BY time DESC NULLS LAST,
             collected_at DESC, {", ".join(f"{m} DESC" for m in MEASURES)}) AS newest
    FROM layers WHERE branch = 'data') WHERE newest = 1)"""


@query(
    "latest_per_device",
    with_(*TO_LAYERS, _LATEST, body=f"SELECT {FIELDS}, ts FROM latest"),
)
def latest_per_device(spark, sf_dir):
    data = layers(spark, sf_dir).filter("branch = 'data'")
    return metrics.latest_per_device(data).drop("branch", "year", "month", "day", "hour")


@query("device_count", with_(*TO_LAYERS, _LATEST, body="SELECT count(*) AS devices FROM latest"))
def device_count(spark, sf_dir):
    return metrics.device_count(latest_per_device(spark, sf_dir))


@query(
    "is_empty",
    with_(
        *TO_LAYERS,
        body=f"""SELECT 'data' AS checked, count(*) = 0 AS empty FROM layers WHERE branch = 'data'
                 UNION ALL SELECT 'future', count(*) = 0 FROM layers WHERE ts > TIMESTAMP '2100-01-01'""",
    ),
)
def is_empty(spark, sf_dir):
    rows = labelled_readings(messages(spark, sf_dir))
    cases = {"data": F.col("branch") == "data", "future": F.col("ts") > F.lit("2100-01-01").cast("timestamp")}
    return metrics.is_empty(rows, cases)


@query(
    "gauge_rows",
    with_(
        *TO_LAYERS,
        _LATEST,
        body=f"""SELECT 'latest_' || metric AS metric, device_id, value FROM (
                   SELECT CAST(DeviceId AS VARCHAR) AS device_id, {MEASURED} FROM latest)
                 UNPIVOT (value FOR metric IN ({MEASURED}))""",
    ),
)
def gauge_rows(spark, sf_dir):
    return monitors.latest_metrics(layers(spark, sf_dir).filter("branch = 'data'"), "latest_")


@query(
    "exposition_lines",
    with_(
        *TO_LAYERS,
        _LATEST,
        body=f"""SELECT metric, device_id, metric || '{{device_id="' || device_id || '"}} ' || CAST(value AS VARCHAR) AS line
                 FROM (SELECT CAST(DeviceId AS VARCHAR) AS device_id, {MEASURED} FROM latest)
                 UNPIVOT (value FOR metric IN ({MEASURED}))""",
    ),
)
def exposition_lines(spark, sf_dir):
    return metrics.to_exposition(monitors.latest_metrics(layers(spark, sf_dir).filter("branch = 'data'")))


@query(
    "error_count_per_device",
    with_(
        *TO_LAYERS,
        body=f"""SELECT DeviceId, count(*) AS error_count FROM layers WHERE branch = 'dataerr'
                 AND ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR AND TIMESTAMP '{AS_OF}' GROUP BY DeviceId""",
    ),
)
def error_count_per_device(spark, sf_dir):
    errors = layers(spark, sf_dir).filter("branch = 'dataerr'")
    return metrics.error_count_per_device(errors, AS_OF, "6 hours")


_HOURLY = """SELECT date_trunc('hour', ts) AS hour_start, DeviceId, branch, count(*) AS readings
             FROM layers WHERE ts IS NOT NULL GROUP BY ALL"""


@query("hourly_branch_counts", with_(*TO_LAYERS, body=_HOURLY))
def hourly_branch_counts(spark, sf_dir):
    return metrics.hourly_branch_counts(layers(spark, sf_dir))
