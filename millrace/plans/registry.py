"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables and the SQL have them."""
    plain = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(plain) if plain else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _zoneless(fn(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


# Common table expressions of the SQL side: the relations of millrace.plans.readings, stated over events.

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def _readings_sql(lag: str) -> str:
    return f"""readings AS (
  SELECT event_id,
         CASE WHEN event_id % 89 <> 0 THEN strftime(ts{lag}, {ISO}) END AS time,
         CAST(user_id % 5 + CASE WHEN event_id % 151 = 0 THEN 98 ELSE 1 END AS INTEGER) AS DeviceId,
         CASE WHEN event_id % 97 <> 0 THEN value END AS sensor1,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS sensor2,
         value + CAST(json_extract(props, '$.k') AS DOUBLE) AS sensor3,
         CAST(event_id * 37 % 2100 AS DOUBLE) AS motor1,
         CAST(event_id * 53 % 1550 AS DOUBLE) AS motor2,
         CAST(event_id * 71 % 1850 AS DOUBLE) AS motor3,
         event_type = 'error' AS isFail,
         CASE WHEN event_id % 131 = 0 THEN 'garbage' ELSE strftime(ts, {ISO}) END AS collected_at
  FROM events)"""


READINGS = _readings_sql("")
LAGGING = _readings_sql(" - to_seconds(event_id % 7 * 20)")

MESSAGES = """messages AS (
  SELECT r.*, c.copy, event_id % 211 = 0 AS cut_off
  FROM readings r JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR r.event_id % 50 = 0)"""

VALID = """(sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150
            AND motor1 BETWEEN 0 AND 2000 AND motor2 BETWEEN 0 AND 1500 AND motor3 BETWEEN 0 AND 1800
            AND DeviceId BETWEEN 1 AND 100)"""

CLEANED = f"""cleaned AS (
  SELECT *, TRY_CAST(collected_at AS TIMESTAMP) AS ts,
         CASE WHEN isFail THEN 'fail' WHEN {VALID} THEN 'data' ELSE 'dataerr' END AS branch
  FROM messages
  WHERE NOT cut_off AND sensor1 IS NOT NULL)"""

LAYERS = """layers AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY DeviceId, sensor1, sensor2, sensor3, motor1, motor2, motor3, isFail
      ORDER BY ts NULLS LAST, time NULLS LAST, collected_at) AS nth
    FROM cleaned) WHERE nth = 1)"""

TO_LAYERS = (READINGS, MESSAGES, CLEANED, LAYERS)

FIELDS = "time, DeviceId, sensor1, sensor2, sensor3, motor1, motor2, motor3, isFail, collected_at"
MEASURED = "sensor1, sensor2, sensor3, motor1, motor2, motor3"

VALUE_METRICS = """metrics AS (
  SELECT metric, device_id, ts, value FROM (
    SELECT CAST(1 + user_id % 5 AS VARCHAR) AS device_id, ts,
           CASE WHEN event_id % 97 <> 0 THEN value END AS sensor1,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS sensor2,
           value + CAST(json_extract(props, '$.k') AS DOUBLE) AS sensor3
    FROM events) UNPIVOT (value FOR metric IN (sensor1, sensor2, sensor3)))"""

COUNTERS = """metrics AS (
  SELECT 'events_total' AS metric, CAST(1 + user_id % 5 AS VARCHAR) AS device_id, ts,
         CAST(event_id % 400 AS DOUBLE) AS value
  FROM events)"""

HOURLY_ERRORS = """metrics AS (
  SELECT 'error_count_per_hour' AS metric, CAST(DeviceId AS VARCHAR) AS device_id,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, CAST(count(*) AS DOUBLE) AS value
  FROM layers WHERE branch = 'dataerr' AND ts IS NOT NULL GROUP BY ALL)"""

HOSTS = """hosts AS (
  SELECT CASE WHEN p_partkey % 20 < 15 THEN 'node' ELSE 'spark' END AS job, CAST(p_partkey % 20 AS VARCHAR) AS instance,
         TIMESTAMP '2024-01-01' + to_minutes(p_partkey // 20) AS ts,
         p_retailprice * p_size / 100 AS mem_available, p_retailprice AS mem_total
  FROM part)"""


def evaluation_sql(series: str, step: str, lookback: str, source: str = "metrics", until: str | None = None) -> str:
    """Every series at every step from its first sample on until its last sample has left the look-back.

    With ``until``, a time on the grid or an expression for one, later samples are unknown and evaluation ends there.
    """
    if until:
        until = until if until.startswith("(") else f"TIMESTAMP '{until}'"
        source = f"(SELECT * FROM {source} WHERE ts <= {until})"
    joined = " AND ".join(f"g.{s.strip()} = m.{s.strip()}" for s in series.split(","))
    return f"""spans AS (
  SELECT {series}, min(time_bucket(INTERVAL '{step}', ts + INTERVAL '{step}' - INTERVAL 1 MICROSECOND)) AS lo,
         greatest(max(time_bucket(INTERVAL '{step}', ts + INTERVAL '{step}' - INTERVAL 1 MICROSECOND)),
                  time_bucket(INTERVAL '{step}', {until or f"max(ts) + INTERVAL '{lookback}'"})) AS hi
  FROM {source} WHERE value IS NOT NULL GROUP BY ALL),
grid AS (
  SELECT {series}, unnest(generate_series(lo, hi, INTERVAL '{step}')) AS eval_ts FROM spans),
samples AS (
  SELECT {series}, ts, max(value) AS value FROM {source} WHERE value IS NOT NULL GROUP BY ALL),
evaluated AS (
  SELECT {", ".join("g." + s.strip() for s in series.split(","))}, g.eval_ts,
         CASE WHEN m.ts >= g.eval_ts - INTERVAL '{lookback}' THEN m.value END AS value
  FROM grid g ASOF LEFT JOIN samples m ON {joined} AND g.eval_ts >= m.ts)"""


def states_sql(series: str, hold: str, keep: str) -> str:
    """The alert as a state machine, one step of all series after the other."""
    cols = [s.strip() for s in series.split(",")]
    same = " AND ".join(f"b.{c} = s.{c}" for c in cols)
    b_cols = ", ".join(f"b.{c}" for c in cols)
    return f"""numbered AS (
  SELECT {series}, eval_ts, value, breach,
         CASE WHEN isnan(value) THEN 'error' WHEN breach IS NULL THEN 'none' WHEN breach THEN 'breach' ELSE 'calm' END AS kind,
         row_number() OVER (PARTITION BY {series} ORDER BY eval_ts) AS n
  FROM breaches),
steps AS (
  SELECT {series}, n, eval_ts, kind, eval_ts AS since,
         kind = 'breach' AND INTERVAL '{hold}' <= INTERVAL 0 SECOND AS active
  FROM numbered WHERE n = 1
  UNION ALL
  SELECT {b_cols}, b.n, b.eval_ts, b.kind,
         CASE WHEN b.kind = s.kind THEN s.since ELSE b.eval_ts END,
         CASE b.kind
           WHEN 'none' THEN false
           WHEN 'error' THEN false
           WHEN 'breach' THEN s.active
             OR b.eval_ts - CASE WHEN b.kind = s.kind THEN s.since ELSE b.eval_ts END >= INTERVAL '{hold}'
           ELSE s.active
             AND b.eval_ts - CASE WHEN b.kind = s.kind THEN s.since ELSE b.eval_ts END < INTERVAL '{keep}'
         END
  FROM steps s JOIN numbered b ON {same} AND b.n = s.n + 1),
states AS (
  SELECT {b_cols}, b.eval_ts, b.value, b.breach,
         CASE WHEN s.kind = 'none' THEN 'NoData'
              WHEN s.kind = 'error' THEN 'Error'
              WHEN s.kind = 'breach' AND s.active THEN 'Firing'
              WHEN s.kind = 'breach' THEN 'Pending'
              WHEN s.active THEN 'Recovering' ELSE 'Normal' END AS state
  FROM steps s JOIN numbered b ON {same} AND b.n = s.n)"""
