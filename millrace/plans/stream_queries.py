"""Streaming jobs over the events table, run until all of it is read, and read back.

Each takes the table as a stream of files, all that are there when it starts, in batches of bounded size. Where
results depend on the order of arrival, the events come by time, as they would from a feed.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.functions.checks import is_json
from millrace.operators import parse
from millrace.plans import monitors
from millrace.plans.readings import event_messages, labelled_readings
from millrace.plans.reading_queries import _HOURLY, _LAYER_ROWS, AS_OF, ID, layers
from millrace.plans.registry import (
    CLEANED,
    FIELDS,
    MESSAGES,
    READINGS,
    TO_LAYERS,
    evaluation_sql,
    query,
    states_sql,
    table,
    with_,
)
from millrace.plans.series_queries import _ERROR_STATES, _GRID_INCREASE, SERIES, _recursive, error_breaches
from millrace.schema import BRANCHES, PARTITIONS
from millrace.session import shared_dir, stateful_settings
from millrace.sinks.layers import write_layer
from millrace.sinks.pointer import folders, make_folder, move
from millrace.sources.layers import scan_layer
from millrace.sources.streams import archive_source, exactly, stream_source, table_stream
from millrace.streaming.alerts import stream_alert_states, stream_alerts
from millrace.streaming.archive import archive_stream
from millrace.streaming.layering import distinct, start_layers
from millrace.streaming.progress import ProgressLog, progress_frame, state_metrics
from millrace.streaming.supervise import keep_running, supervise
from millrace.streaming.windows import streaming_branch_counts, streaming_error_counts


# A batch of a terabyte is done over when it fails, not the whole table.
BATCH = {"maxBytesPerTrigger": str(10**12)}
#: Batches of a feed at least, whatever the table's size.
LEAST_BATCHES = 5
#: Files of a feed at least, and bytes of the events that one of them is written for.
LEAST_FILES, FILE_SIZE = 20, 2**27
#: The longest that a reading may be behind the latest one.
DELAY = "10 minutes"
#: Files per hour and batch of the layered writes; an hour of the table is small.
FILES_PER_HOUR = 1


def message_stream(spark, sf_dir, **options):
    return event_messages(table_stream(spark, f"{sf_dir}/events.parquet", **options))


class Feed:
    """The events of the table in order of arrival, as a stream of slices of event time that are let in one after the other.

    One job writes all slices aside, by ranges of time; events without a time come first. Then a slice is moved into the
    folder that the stream reads, one rename each, and the next one follows when it has been read; so a batch holds a
    slice, whatever the age and the order of its files. There are as many slices as batches of bounded size are needed.
    """

    def __init__(self, spark, sf_dir):
        events = table(spark, sf_dir, "events")
        size = int(events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        files = max(LEAST_FILES, -(-size // FILE_SIZE))
        self.slices = min(files, max(LEAST_BATCHES, -(-size // int(BATCH["maxBytesPerTrigger"]))))
        self.spark, self.aside, self.path = spark, shared_dir(spark, "slices"), shared_dir(spark, "feed")
        # by event_id as well, so that an instant with many events is not one file
        dealt = events.repartitionByRange(files, "ts", "event_id")
        dealt = dealt.withColumn("slice", F.floor(F.spark_partition_id() * self.slices / files))
        dealt.write.partitionBy("slice").parquet(self.aside)
        make_folder(spark, self.path)
        self.events = stream_source(spark, "parquet", self.path, events.schema, recursiveFileLookup="true")
        self.messages = event_messages(self.events)

    def play(self, job) -> None:
        """Let the slices in and wait until the job has read each; then end the job."""
        try:
            for name in sorted(folders(self.spark, self.aside, "slice="), key=lambda n: int(n.split("=")[1])):
                move(self.spark, f"{self.aside}/{name}", f"{self.path}/{name}")
                job.processAllAvailable()
        finally:
            job.stop()


def state_partitions(spark) -> int:
    return spark.sparkContext.defaultParallelism


def through(spark, stream, label: str, mode: str = "append", feed: Feed | None = None):
    """Run a stream into a parquet table, over what is there or as its feed comes in, and read the table."""
    path = shared_dir(spark, label)
    pace = {"processingTime": "0 seconds"} if feed else {"availableNow": True}
    with stateful_settings(spark, state_partitions(spark)):
        job = (
            stream.writeStream.format("parquet")
            .outputMode(mode)
            .option("checkpointLocation", f"{path}_checkpoint")
            .trigger(**pace)
            .start(path)
        )
    if feed:
        feed.play(job)
    else:
        supervise(spark, [job])
    return spark.read.schema(stream.schema).parquet(path)


def run_layers(spark, path, messages, **options):
    """Run the layered write to its end."""
    jobs = start_layers(
        messages,
        path,
        trigger=None,
        files_per_hour=FILES_PER_HOUR,
        state_partitions=state_partitions(spark),
        **options,
    )
    supervise(spark, jobs)
    return jobs


def reported(spark, stream, name: str, feed: Feed):
    """Run a stream to the end of its feed and read the table of its batch reports."""
    path, reports = shared_dir(spark, name), shared_dir(spark, "reports")
    log = ProgressLog(spark, reports, names=[name])
    spark.streams.addListener(log)
    try:
        with stateful_settings(spark, state_partitions(spark)):
            job = write_layer(stream, path, name, "0 seconds", "parquet", partitions=["branch"])
        feed.play(job)
        log.wait(job)
    finally:
        spark.streams.removeListener(log)
        log.close()
    return progress_frame(spark, reports)


@query(
    "stream_source",
    with_(READINGS, MESSAGES, body="SELECT event_id, copy, CAST(DeviceId AS VARCHAR) AS key FROM messages"),
)
def stream_source_(spark, sf_dir):
    return through(spark, message_stream(spark, sf_dir, **BATCH).select(*ID, "key"), "stream-source")


@query("layered_write", with_(*TO_LAYERS, body=_LAYER_ROWS))
def layered_write(spark, sf_dir):
    path = shared_dir(spark, "stream-layers")
    run_layers(spark, path, message_stream(spark, sf_dir, **BATCH))
    return scan_layer(spark, path).drop("year", "month", "day", "hour")


@query(
    "layered_write_separate",
    with_(
        *TO_LAYERS,
        body=f"""SELECT 'raw-data' AS layer, {FIELDS} FROM layers
                 UNION ALL SELECT branch, {FIELDS} FROM layers""",
    ),
)
def layered_write_separate(spark, sf_dir):
    path = shared_dir(spark, "stream-separate")
    run_layers(spark, path, message_stream(spark, sf_dir, **BATCH), separate=True)
    parts = [
        scan_layer(spark, path, layer, separate=True).select(F.lit(layer).alias("layer"), *FIELDS.split(", "))
        for layer in ("raw-data", *BRANCHES)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("checkpoint_recovery", with_(*TO_LAYERS, body=_LAYER_ROWS))
def checkpoint_recovery(spark, sf_dir):
    """Started again on its own checkpoint, the job takes what is new since and repeats nothing: of the events in
    the folder, each run finds one half more, and the third finds nothing."""
    path, source = shared_dir(spark, "stream-again"), shared_dir(spark, "stream-source")
    half = F.col("event_id") % 2
    events = table(spark, sf_dir, "events")
    for new in (events.filter(half == 0), events.filter(half == 1), None):
        if new is not None:
            new.write.mode("append").parquet(source)
        run_layers(spark, path, event_messages(table_stream(spark, source, **BATCH)))
    return scan_layer(spark, path).drop("year", "month", "day", "hour")


class Failure(Exception):
    """Made for a test of recovery."""


def write_halves(spark, events, path: str) -> int:
    """Write events for a stream of two batches and return the files of one.

    A file that has one row group is parsed by one task, so a batch has a file for every task of the session, and more
    where those would be large.
    """
    size = int(events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    files = 2 * max(state_partitions(spark), -(-size // FILE_SIZE))
    events.repartition(files, "event_id").write.parquet(path)
    return -(-len(spark.read.parquet(path).inputFiles()) // 2)  # no file comes of a part without events


@query(
    "checkpoint_recovery_within_batch",
    with_(
        *TO_LAYERS,
        body=f"""SELECT 'raw-data' AS layer, {FIELDS} FROM layers
                 UNION ALL SELECT branch, {FIELDS} FROM layers""",
    ),
)
def checkpoint_recovery_within_batch(spark, sf_dir):
    """A job that fails within its batches: after the files of some layers, before and after its batch is valid but
    before its state is. Each time it is started again on its checkpoint, and every reading is in its layers once."""
    path, source = shared_dir(spark, "stream-failing"), shared_dir(spark, "stream-source")
    half = write_halves(spark, table(spark, sf_dir, "events"), source)
    failures = {("written fail", 0), ("committed", 0), ("indexed", 1)}
    count = len(failures)

    def probe(stage: str, batch: int) -> None:
        if (stage, batch) in failures:
            failures.remove((stage, batch))
            raise Failure(f"{stage} of batch {batch}")

    def start():
        messages = event_messages(table_stream(spark, source, maxFilesPerTrigger=str(half)))
        options = dict(files_per_hour=FILES_PER_HOUR, state_partitions=state_partitions(spark))
        return start_layers(messages, path, trigger=None, separate=True, probe=probe, merge=2, **options)[0]

    restarts = keep_running({"layers": start}, restarts=count, wait=0.1)
    if failures or restarts["layers"] != count:
        raise AssertionError(f"not failed: {failures}")
    parts = [
        scan_layer(spark, path, layer, separate=True).select(F.lit(layer).alias("layer"), *FIELDS.split(", "))
        for layer in ("raw-data", *BRANCHES)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "multi_query_supervision",
    with_(
        *TO_LAYERS,
        body=f"""SELECT 'raw-data' AS layer, {FIELDS} FROM layers
                 UNION ALL SELECT branch, {FIELDS} FROM layers""",
    ),
)
def multi_query_supervision(spark, sf_dir):
    """A query for each layer, of which the second fails once amid its work and is started again; the others run on."""
    path = shared_dir(spark, "stream-supervised")
    started = []

    def starter(layer):
        def start():
            started.append(layer)
            rows = labelled_readings(message_stream(spark, sf_dir, **BATCH))
            own = rows if layer == "raw-data" else rows.filter(F.col("branch") == layer)
            found = distinct(own)
            if layer == "fail" and started.count(layer) == 1:
                broken = F.when(F.col("DeviceId") >= 0, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("DeviceId"))
                found = found.withColumn("DeviceId", broken)
            with stateful_settings(spark, state_partitions(spark)):
                return write_layer(found, f"{path}/{layer}", f"supervised-{layer}", None, files_per_hour=FILES_PER_HOUR)

        return start

    names = ("raw-data", *BRANCHES)
    restarts = keep_running({layer: starter(layer) for layer in names}, wait=0.1)
    if restarts != {layer: int(layer == "fail") for layer in names}:
        raise AssertionError(f"restarts {restarts}")
    parts = [
        scan_layer(spark, path, layer, separate=True).select(F.lit(layer).alias("layer"), *FIELDS.split(", ")) for layer in names
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "partition_index_scan",
    with_(
        *TO_LAYERS,
        body=f"""SELECT branch, {FIELDS}, ts FROM layers
                 WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND ts < TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR""",
    ),
)
def partition_index_scan(spark, sf_dir):
    """Two hours of a root that a stream has written, from the folders that its index has for them."""
    path, at = shared_dir(spark, "stream-indexed"), datetime.fromisoformat(AS_OF)
    run_layers(spark, path, message_stream(spark, sf_dir, **BATCH), committed=True)
    found = scan_layer(spark, path, None, at - timedelta(hours=1), at + timedelta(hours=1))
    return found.drop(*PARTITIONS)


_PER_DEVICE = "SELECT DeviceId, branch, count(*) AS readings FROM layers{} GROUP BY ALL"


def per_device(rows):
    return rows.groupBy("DeviceId", "branch").agg(F.count("*").alias("readings"))


@query("stateful_dedup", with_(*TO_LAYERS, body=_PER_DEVICE.format("")))
def stateful_dedup(spark, sf_dir):
    """Every distinct reading is remembered."""
    rows = labelled_readings(message_stream(spark, sf_dir, **BATCH))
    return per_device(through(spark, distinct(rows), "exact-dedup"))


@query("dedup_bounded", with_(*TO_LAYERS, body=_PER_DEVICE.format("")))
def dedup_bounded(spark, sf_dir):
    """Readings are forgotten after a while, those without a time never."""
    feed = Feed(spark, sf_dir)
    rows = labelled_readings(feed.messages)
    return per_device(through(spark, distinct(rows, "bounded", DELAY), "bounded-dedup", feed=feed))


@query("micro_batch_trigger", with_(*TO_LAYERS, body=_PER_DEVICE.format("")))
def micro_batch_trigger(spark, sf_dir):
    """The same on a clock, stopped when it has caught up."""
    path, feed = shared_dir(spark, "ticking"), Feed(spark, sf_dir)
    rows = distinct(labelled_readings(feed.messages))
    with stateful_settings(spark, state_partitions(spark)):
        job = write_layer(rows, path, "ticking", "1 second", "parquet", partitions=["branch"])
    feed.play(job)
    return per_device(spark.read.schema(rows.schema).parquet(path))


@query(
    "ingest_archive",
    with_(READINGS, MESSAGES, body=f"SELECT {FIELDS} FROM messages WHERE NOT cut_off"),
)
def ingest_archive(spark, sf_dir):
    path = shared_dir(spark, "archive")
    table_path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(table_path).schema
    events = archive_source(spark, "parquet", path=exactly(table_path), schema=schema, **BATCH)
    job = archive_stream(event_messages(events), path, trigger=None)
    supervise(spark, [job])
    return parse.parse_reading(spark.read.text(path).select("value"))


@query(
    "streaming_window_count",
    with_(
        READINGS,
        MESSAGES,
        CLEANED,
        body=_HOURLY.replace("FROM layers", "FROM cleaned").replace(
            "GROUP BY ALL",
            """AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (
                 SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM cleaned) GROUP BY ALL""",
        ),
    ),
)
def streaming_window_count(spark, sf_dir):
    """Hours that the watermark has closed."""
    feed = Feed(spark, sf_dir)
    counts = streaming_branch_counts(labelled_readings(feed.messages), delay=DELAY)
    return through(spark, counts, "windows", feed=feed)


_PROGRESS = with_(
    *TO_LAYERS,
    body="""SELECT 'layers' AS name, (SELECT count(*) FROM events) AS input_rows,
                   (SELECT count(*) FROM layers) AS state_rows, CAST(0 AS BIGINT) AS late_rows""",
)


def layers_progress(spark, sf_dir):
    feed = Feed(spark, sf_dir)
    return reported(spark, distinct(labelled_readings(feed.messages)), "layers", feed)


@query("progress_metrics", _PROGRESS)
def progress_metrics(spark, sf_dir):
    """Rows read over all batches and distinct readings held at the end; times vary and are left out."""
    return layers_progress(spark, sf_dir).groupBy("name").agg(
        F.sum("numInputRows").alias("input_rows"),
        F.max("stateRows").alias("state_rows"),
        F.sum("lateRows").alias("late_rows"),
    )


@query(
    "stream_state_metrics",
    with_(
        *TO_LAYERS,
        body="""SELECT 'layers_latency' AS metric, CAST(1 AS DOUBLE) AS value
                UNION ALL SELECT 'layers_input_rows', CAST(count(*) AS DOUBLE) FROM events
                UNION ALL SELECT 'layers_late_rows', CAST(0 AS DOUBLE)
                UNION ALL SELECT 'layers_states_rowsTotal', CAST(count(*) AS DOUBLE) FROM layers""",
    ),
)
def stream_state_metrics(spark, sf_dir):
    """The metric samples of the batches, summed up; of the latency, which varies, only the sign."""
    name = F.col("metric")
    value = (
        F.when(name.endswith("_latency"), F.signum(F.max("value")))
        .when(name.endswith("_input_rows"), F.sum("value"))
        .otherwise(F.max("value"))
    )
    return state_metrics(layers_progress(spark, sf_dir)).groupBy("metric").agg(value.alias("value"))


@query(
    "batch_latency_bands",
    with_(
        READINGS,
        body="""SELECT 'layers_latency' AS metric, true AS banded, CAST(1 AS BIGINT) AS series
                FROM readings LIMIT 1""",
    ),
)
def batch_latency_bands(spark, sf_dir):
    """Every batch of the job has a band; which one depends on the machine."""
    bands = monitors.batch_latency_bands(layers_progress(spark, sf_dir))
    return bands.groupBy("metric").agg(
        F.bool_and(F.col("band").isNotNull()).alias("banded"), F.countDistinct("name").alias("series")
    )


_HELD = """metrics AS (
  SELECT 'q' || CAST(user_id % 4 AS VARCHAR) AS device_id, ts, 'held' AS metric,
         CAST(event_id % 400 AS DOUBLE) AS value FROM events)"""


@query(
    "records_per_minute",
    with_(
        _HELD,
        _GRID_INCREASE,
        """shifted AS (
  SELECT device_id, ts, increase FROM stepped
  UNION ALL SELECT device_id, ts + INTERVAL 1 HOUR, increase FROM stepped)""",
        body="""SELECT device_id AS name, ts, round(avg(increase), 6) AS mean, count(*) AS steps
                FROM shifted GROUP BY ALL""",
    ),
)
def records_per_minute(spark, sf_dir):
    """Events as the reports of four queries, whose state grows and restarts now and then."""
    name = F.concat(F.lit("q"), F.col("user_id") % 4)
    reports = table(spark, sf_dir, "events").select(
        name.alias("name"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(1).alias("triggerMs"),
        F.lit(1).alias("numInputRows"),
        F.lit(0).alias("lateRows"),
        (F.col("event_id") % 400).alias("stateRows"),
    )
    found = monitors.records_per_minute(reports, "1 hour", "2 hours", "1 hour")
    return found.withColumn("mean", F.round("mean", 6))


@query(
    "error_monitor",
    with_(
        *TO_LAYERS,
        body=f"""SELECT 'errors' AS metric, CAST(DeviceId AS VARCHAR) AS device_id, CAST(count(*) AS DOUBLE) AS value
                 FROM layers WHERE branch = 'dataerr'
                 AND ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND TIMESTAMP '{AS_OF}' GROUP BY ALL""",
    ),
)
def error_monitor(spark, sf_dir):
    """Implausible readings of the hour before an instant, from the folders of the two hours it touches."""
    path = shared_dir(spark, "monitored")
    write_layer(layers(spark, sf_dir), path, partitions=("branch", *PARTITIONS), least_share="64k")
    return monitors.monitor_errors(spark, path, datetime.fromisoformat(AS_OF), "errors", by_folder=True)


@query("write_records", with_(*TO_LAYERS, body="SELECT CAST(DeviceId AS VARCHAR) AS key, count(*) AS records FROM layers GROUP BY ALL"))
def write_records(spark, sf_dir):
    """Layers as messages, sent to files in place of a topic."""
    path = shared_dir(spark, "records")
    parse.write_records(parse.encode_records(layers(spark, sf_dir)), "parquet", path)
    sent = spark.read.schema("key string, value string").parquet(path).filter(is_json(F.col("value")))
    return sent.groupBy("key").agg(F.count("*").alias("records"))


@query(
    "stream_alert_states",
    _recursive(*_ERROR_STATES, body="SELECT metric, device_id, eval_ts, value, breach, state FROM states"),
)
def stream_alert_states_(spark, sf_dir):
    """The batch evaluations, sent through the stateful form of the alert."""
    path = shared_dir(spark, "breaches")
    breaches = error_breaches(spark, sf_dir)
    breaches.write.parquet(path)
    stream = stream_source(spark, "parquet", path=path, schema=breaches.schema, **BATCH)
    return through(spark, stream_alert_states(stream, "1 hour", "1 hour"), "alert-states")


_RESTLESS = f"""metrics AS (
  SELECT 'sensor1' AS metric, CAST(1 + user_id % 5 AS VARCHAR) AS device_id, ts,
         CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value
  FROM events
  WHERE ts IS NOT NULL AND NOT (user_id % 5 = 0 AND ts >= TIMESTAMP '{AS_OF}') AND NOT (user_id % 5 = 1 AND hour(ts) BETWEEN 3 AND 5))"""


@query(
    "stream_alerts",
    _recursive(
        _RESTLESS,
        """closing AS (
  SELECT time_bucket(INTERVAL '30 minutes', date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE) AS until FROM metrics)""",
        evaluation_sql(SERIES, "30 minutes", "1 hour", until="(SELECT until FROM closing)"),
        "breaches AS (SELECT *, CASE WHEN NOT isnan(value) THEN value > 30 END AS breach FROM evaluated)",
        states_sql(SERIES, "1 hour", "1 hour"),
        body="""SELECT metric, device_id, eval_ts, CASE WHEN state <> 'Error' THEN value END AS value, breach, state FROM states""",
    ),
)
def stream_alerts_(spark, sf_dir):
    """A feed of samples with gaps, evaluated as the watermark goes on, also where no sample comes any more."""
    feed = Feed(spark, sf_dir)
    samples = monitors.restless_metrics(feed.events, AS_OF)
    states = stream_alerts(samples, ">", 30, "30 minutes", "1 hour", "1 hour", "1 hour", DELAY)
    told = through(spark, states, "alerts", feed=feed)
    return told.withColumn("value", F.when(F.col("state") != "Error", F.col("value")))


@query(
    "streaming_error_count",
    with_(
        READINGS,
        MESSAGES,
        CLEANED,
        """instants AS (
  SELECT DeviceId, unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, ts + INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND),
                                          ts + INTERVAL 1 HOUR, INTERVAL 10 MINUTE)) AS as_of
  FROM cleaned WHERE branch = 'dataerr' AND ts IS NOT NULL)""",
        body="""SELECT as_of, DeviceId, count(*) AS error_count FROM instants
                WHERE as_of <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM cleaned WHERE branch = 'dataerr')
                GROUP BY ALL""",
    ),
)
def streaming_error_count(spark, sf_dir):
    """Implausible readings of the trailing hour per device, every ten minutes that the watermark passes."""
    feed = Feed(spark, sf_dir)
    errors = labelled_readings(feed.messages).filter("branch = 'dataerr'")
    return through(spark, streaming_error_counts(errors, every="10 minutes", delay=DELAY), "error-counts", feed=feed)
