"""Metric frames, counters, evaluations, bands and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import alerts, clean, metrics, series
from millrace.plans import monitors
from millrace.plans.reading_queries import AS_OF, layers
from millrace.plans.registry import (
    COUNTERS,
    HOSTS,
    HOURLY_ERRORS,
    TO_LAYERS,
    VALUE_METRICS,
    evaluation_sql,
    query,
    states_sql,
    table,
    with_,
)
from millrace.schema import GAUGE_STEPS, LATENCY_STEPS

SERIES = "metric, device_id"


def values(spark, sf_dir):
    return monitors.value_metrics(table(spark, sf_dir, "events"))


def counters(spark, sf_dir):
    return monitors.counter_metrics(table(spark, sf_dir, "events"))


def hourly_errors(spark, sf_dir):
    return monitors.hourly_error_metrics(layers(spark, sf_dir).filter("branch = 'dataerr'"))


@query(
    "label_regex_filter",
    with_(
        VALUE_METRICS,
        body="SELECT metric, device_id, ts, value FROM metrics WHERE regexp_full_match(device_id, '[1-3]|5')",
    ),
)
def label_regex_filter(spark, sf_dir):
    return clean.label_regex_filter(values(spark, sf_dir), "device_id", "[1-3]|5")


@query(
    "label_values",
    with_(
        VALUE_METRICS,
        body="SELECT DISTINCT device_id FROM metrics WHERE metric = 'sensor1' ORDER BY device_id",
    ),
)
def label_values(spark, sf_dir):
    return metrics.label_values(values(spark, sf_dir), "sensor1")


_REDUCED = """reduced AS (
  SELECT metric, device_id, arg_min(value, ts) AS first, avg(value) AS mean, arg_max(value, ts) AS last
  FROM metrics GROUP BY ALL)"""


@query(
    "legend_reduce",
    with_(
        VALUE_METRICS,
        _REDUCED,
        body="SELECT metric, device_id, first, round(mean, 6) AS mean, last FROM reduced",
    ),
)
def legend_reduce(spark, sf_dir):
    return metrics.legend_reduce(values(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@query(
    "legend_sort",
    with_(
        VALUE_METRICS,
        _REDUCED,
        body="SELECT metric, device_id, last FROM reduced ORDER BY last DESC NULLS LAST, metric, device_id",
    ),
)
def legend_sort(spark, sf_dir):
    reduced = metrics.legend_reduce(values(spark, sf_dir))
    return metrics.legend_sort(reduced).select("metric", "device_id", "last")


_INCREASE = """grown AS (
  SELECT metric, device_id, ts, value,
         CASE WHEN value < p THEN value WHEN p IS NOT NULL THEN value - p END AS step
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, device_id ORDER BY ts) AS p FROM metrics)),
increases AS (
  SELECT metric, device_id, ts, value,
         CASE WHEN count(*) OVER w > 1 THEN sum(step) OVER w - coalesce(first_value(step) OVER w, 0) END AS increase
  FROM grown
  WINDOW w AS (PARTITION BY metric, device_id ORDER BY ts
               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))"""


@query(
    "counter_increase",
    with_(
        COUNTERS,
        _INCREASE,
        body="SELECT metric, device_id, ts, value, round(increase, 6) AS increase FROM increases",
    ),
)
def counter_increase(spark, sf_dir):
    grown = series.counter_increase(counters(spark, sf_dir), "1 hour")
    return grown.withColumn("increase", F.round("increase", 6))


_GRID_INCREASE = """lo AS (
  SELECT *, time_bucket(INTERVAL 1 HOUR, ts + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND) AS tick FROM metrics),
windows AS (
  SELECT metric, device_id, tick, ts, value FROM lo
  UNION ALL
  SELECT metric, device_id, tick + INTERVAL 1 HOUR, ts, value FROM lo WHERE tick = ts),
steps AS (
  SELECT metric, device_id, tick, value, lag(value) OVER (PARTITION BY metric, device_id, tick ORDER BY ts) AS p
  FROM windows),
stepped AS (
  SELECT metric, device_id, tick AS ts, sum(CASE WHEN value < p THEN value ELSE value - p END) AS increase
  FROM steps WHERE p IS NOT NULL GROUP BY ALL)"""


@query(
    "counter_increase_grid",
    with_(COUNTERS, _GRID_INCREASE, body="SELECT metric, device_id, ts, round(increase, 6) AS increase FROM stepped"),
)
def counter_increase_grid(spark, sf_dir):
    grown = series.counter_increase_grid(counters(spark, sf_dir), "1 hour", "1 hour")
    return grown.withColumn("increase", F.round("increase", 6))


@query(
    "avg_over_time",
    with_(
        COUNTERS,
        _GRID_INCREASE,
        """shifted AS (
  SELECT metric, device_id, ts, increase FROM stepped
  UNION ALL SELECT metric, device_id, ts + INTERVAL 1 HOUR, increase FROM stepped)""",
        body="""SELECT metric, device_id, ts, round(avg(increase), 6) AS mean, count(*) AS steps
                FROM shifted GROUP BY ALL""",
    ),
)
def avg_over_time(spark, sf_dir):
    grown = series.counter_increase_grid(counters(spark, sf_dir), "1 hour", "1 hour")
    return series.avg_over_time(grown, "2 hours", "1 hour").withColumn("mean", F.round("mean", 6))


@query(
    "instant_value",
    with_(
        VALUE_METRICS,
        evaluation_sql(SERIES, "30 minutes", "1 hour"),
        body="SELECT metric, device_id, eval_ts, value FROM evaluated WHERE value IS NOT NULL",
    ),
)
def instant_value(spark, sf_dir):
    return series.instant_value(values(spark, sf_dir), "30 minutes", "1 hour")


@query(
    "instant_value_until",
    with_(
        VALUE_METRICS,
        evaluation_sql(SERIES, "30 minutes", "1 hour", until=AS_OF),
        body="SELECT metric, device_id, eval_ts, value FROM evaluated WHERE value IS NOT NULL",
    ),
)
def instant_value_until(spark, sf_dir):
    """Evaluation that ends amid the data."""
    return series.instant_value(values(spark, sf_dir), "30 minutes", "1 hour", until=AS_OF)


@query(
    "alert_threshold_until",
    with_(
        VALUE_METRICS,
        evaluation_sql(SERIES, "30 minutes", "1 hour", until=AS_OF),
        body="SELECT metric, device_id, eval_ts, value, value > 75 AS breach FROM evaluated",
    ),
)
def alert_threshold_until(spark, sf_dir):
    return alerts.alert_threshold(values(spark, sf_dir), ">", 75, "30 minutes", "1 hour", until=AS_OF)


@query(
    "instant_value_at",
    with_(
        VALUE_METRICS,
        body=f"""SELECT metric, device_id, max(ts) AS ts, arg_max(value, ts) AS value FROM metrics
                 WHERE ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND TIMESTAMP '{AS_OF}' GROUP BY ALL""",
    ),
)
def instant_value_at(spark, sf_dir):
    return series.instant_value_at(values(spark, sf_dir), AS_OF, "1 hour")


_SAMPLES = """samples AS (
  SELECT metric, device_id, ts, max(value) AS value FROM metrics WHERE value IS NOT NULL GROUP BY ALL)"""


@query(
    "instant_value_times",
    with_(
        VALUE_METRICS,
        _SAMPLES,
        "times AS (SELECT DISTINCT ts AS eval_ts FROM events WHERE event_type = 'error' AND ts IS NOT NULL)",
        "asked AS (SELECT * FROM (SELECT DISTINCT metric, device_id FROM samples), times)",
        body="""SELECT a.metric, a.device_id, eval_ts, value
                FROM asked a ASOF JOIN samples m ON a.metric = m.metric AND a.device_id = m.device_id AND eval_ts >= m.ts
                WHERE m.ts >= eval_ts - INTERVAL 20 MINUTE""",
    ),
)
def instant_value_times(spark, sf_dir):
    """Every series at the times of all failures, which lie on no grid."""
    failures = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("ts").alias("eval_ts"))
    return series.instant_value(values(spark, sf_dir), failures, "20 minutes")


@query(
    "instant_value_by_device",
    with_(
        VALUE_METRICS,
        _SAMPLES,
        """asked AS (SELECT DISTINCT metric, device_id, ts AS eval_ts
                     FROM (SELECT CAST(1 + user_id % 5 AS VARCHAR) AS device_id, ts FROM events WHERE event_type = 'error'),
                          (SELECT DISTINCT metric FROM samples) WHERE ts IS NOT NULL)""",
        body="""SELECT a.metric, a.device_id, eval_ts, m.ts, value
                FROM asked a ASOF JOIN samples m ON a.metric = m.metric AND a.device_id = m.device_id AND eval_ts >= m.ts
                WHERE m.ts >= eval_ts - INTERVAL 1 DAY""",
    ),
)
def instant_value_by_device(spark, sf_dir):
    """The series of a device at the times of its own failures, each with the time it was measured."""
    device = (F.col("user_id") % 5 + 1).cast("string").alias("device_id")
    failures = table(spark, sf_dir, "events").filter("event_type = 'error'").select(device, F.col("ts").alias("eval_ts"))
    return series.instant_value_at_times(values(spark, sf_dir), failures, "1 day")


_USED = """used AS (
  SELECT a.job, a.instance, a.ts, (1 - a.mem_available / t.mem_total) * 100 AS value
  FROM hosts a JOIN hosts t ON a.job = t.job AND a.instance = t.instance AND a.ts = t.ts
  WHERE a.job = 'node' AND a.mem_available IS NOT NULL AND t.mem_total IS NOT NULL)"""


@query(
    "metric_ratio_join",
    with_(HOSTS, _USED, body="SELECT job, instance, ts, round(value, 6) AS value FROM used"),
)
def metric_ratio_join(spark, sf_dir):
    hosts = monitors.host_metrics(table(spark, sf_dir, "part"))
    used = metrics.metric_ratio_join(
        hosts, "mem_available", "mem_total", ("job", "instance", "ts"), F.col("job") == "node"
    )
    return used.withColumn("value", F.round("value", 6))


@query(
    "threshold_band",
    with_(
        VALUE_METRICS,
        body="""SELECT metric, device_id, ts, value,
                       CASE WHEN value IS NULL THEN NULL WHEN value < 0 THEN 'red'
                            WHEN value >= CASE WHEN metric = 'sensor3' THEN 130 ELSE 90 END THEN 'red'
                            ELSE 'green' END AS band FROM metrics""",
    ),
)
def threshold_band(spark, sf_dir):
    return metrics.threshold_band(values(spark, sf_dir), GAUGE_STEPS)


@query(
    "error_stat_band",
    with_(
        *TO_LAYERS,
        HOURLY_ERRORS,
        body="SELECT device_id, ts, value, CASE WHEN value >= 3 THEN 'red' ELSE 'green' END AS band FROM metrics",
    ),
)
def error_stat_band(spark, sf_dir):
    """Counts in the given tables are small, so the step is set to match."""
    steps = ((None, "green"), (3, "red"))
    return monitors.error_bands(hourly_errors(spark, sf_dir), steps).drop("metric")


@query(
    "latency_band",
    """SELECT event_id, value * 100 AS value, CASE WHEN value * 100 >= 7000 THEN 'red' ELSE 'green' END AS band
       FROM events""",
)
def latency_band(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", (F.col("value") * 100).alias("value"))
    return metrics.threshold_band(events, LATENCY_STEPS)


_ERROR_BREACHES = (
    *TO_LAYERS,
    HOURLY_ERRORS,
    evaluation_sql(SERIES, "30 minutes", "2 hours"),
    "breaches AS (SELECT *, value > 1 AS breach FROM evaluated)",
)


def error_breaches(spark, sf_dir):
    return monitors.error_alerts(hourly_errors(spark, sf_dir), 1, every="30 minutes", lookback="2 hours")


@query(
    "alert_threshold",
    with_(*_ERROR_BREACHES, body="SELECT metric, device_id, eval_ts, value, breach FROM breaches"),
)
def alert_threshold(spark, sf_dir):
    return error_breaches(spark, sf_dir)


_ERROR_STATES = (*_ERROR_BREACHES, states_sql(SERIES, "1 hour", "1 hour"))


def _recursive(*parts: str, body: str) -> str:
    return with_(*parts, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "alert_pending_firing",
    _recursive(*_ERROR_STATES, body="SELECT metric, device_id, eval_ts, value, breach, state FROM states"),
)
def alert_pending_firing(spark, sf_dir):
    return alerts.alert_states(error_breaches(spark, sf_dir), "1 hour", "1 hour")


@query(
    "alert_messages",
    _recursive(
        *_ERROR_STATES,
        body="""SELECT metric, device_id, eval_ts, previous, state, value,
                       'too many errors: ' || metric || ' ' || device_id || ' ' || previous || ' -> ' || state AS message
                FROM (SELECT *, coalesce(lag(state) OVER (PARTITION BY metric, device_id ORDER BY eval_ts), 'Normal')
                             AS previous FROM states) WHERE previous <> state""",
    ),
)
def alert_messages(spark, sf_dir):
    states = alerts.alert_states(error_breaches(spark, sf_dir), "1 hour", "1 hour")
    return alerts.alert_messages(states, "too many errors")


@query(
    "alert_node_memory",
    _recursive(
        HOSTS,
        _USED,
        evaluation_sql("job, instance", "1 minute", "10 minutes", "used"),
        "breaches AS (SELECT *, value > 75 AS breach FROM evaluated)",
        states_sql("job, instance", "1 minute", "30 seconds"),
        body="SELECT job, instance, eval_ts, round(value, 6) AS value, breach, state FROM states",
    ),
)
def alert_node_memory(spark, sf_dir):
    hosts = monitors.host_metrics(table(spark, sf_dir, "part"))
    states = alerts.alert_node_memory(hosts, "mem_available", "mem_total", where=F.col("job") == "node")
    return states.withColumn("value", F.round("value", 6))
