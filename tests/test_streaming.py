from __future__ import annotations

import glob
import json
import random
import threading
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_bounded
from millrace.functions.clock import micros
from millrace.operators.metrics import error_count_per_device, hourly_branch_counts
from millrace.operators.parse import event_time
from millrace.plans import stream_queries
from millrace.plans.monitors import batch_latency_bands
from millrace.plans.readings import distinct_layers, event_messages, labelled_readings
from millrace.schema import BRANCHES, DEDUP_KEYS, READING_SCHEMA
from millrace.session import shared_dir, stateful_settings
from millrace.sinks.committed import committed
from millrace.sinks.layers import write_layer
from millrace.sources.layers import scan_layer
from millrace.sources.streams import archive_source, stream_source, table_stream
from millrace.streaming.archive import archive_stream
from millrace.streaming.layering import start_layers
from millrace.streaming.progress import ProgressLog, progress_frame, state_metrics
from millrace.streaming.supervise import keep_running, supervise
from millrace.streaming.windows import streaming_branch_counts, streaming_error_counts

EVENTS = "/root/testdata/sf0.001/events.parquet"
KEYS = [*DEDUP_KEYS, "branch"]


@pytest.fixture(scope="module")
def messages(spark):
    """The messages of 300 events, in four text files."""
    path = shared_dir(spark, "messages")
    events = spark.read.parquet(EVENTS).filter("event_id < 300")
    event_messages(events).orderBy("event_id").select("value").coalesce(1).write.option("maxRecordsPerFile", 80).text(path)
    assert len(glob.glob(f"{path}/part-*")) >= 3
    return path


def stream(spark, path, **options):
    return stream_source(spark, "text", path=path, **options)


def keys(df, *extra):
    return sorted(map(tuple, df.select(*KEYS, *extra).collect()))


@pytest.mark.parametrize("separate", [False, True])
def test_stream_over_several_files_equals_batch(spark, messages, separate):
    out = shared_dir(spark, "out")
    jobs = start_layers(
        stream(spark, messages, maxFilesPerTrigger="1"), out, separate=separate, trigger=None,
        state_partitions=2, files_per_hour=1,
    )
    supervise(spark, jobs)
    batch = distinct_layers(spark.read.text(messages))
    if not separate:
        assert jobs[0].lastProgress["batchId"] >= 2
        assert keys(scan_layer(spark, out)) == keys(batch)
        return
    for layer in BRANCHES:
        got = scan_layer(spark, out, layer, separate=True).withColumn("branch", F.lit(layer))
        assert keys(got) == keys(batch.filter(F.col("branch") == layer))
    raw = scan_layer(spark, out, "raw-data", separate=True).withColumn("branch", F.lit("raw"))
    assert keys(raw) == keys(batch.withColumn("branch", F.lit("raw")))


def test_restart_goes_on_without_loss_or_repeat(spark, messages):
    source, out = shared_dir(spark, "source"), shared_dir(spark, "out")
    lines = spark.read.text(messages).withColumn("half", F.monotonically_increasing_id() % 2)
    for half in (0, 1, 1):  # the third run gets copies only
        lines.filter(F.col("half") == half).select("value").coalesce(1).write.mode("append").text(source)
        supervise(spark, start_layers(stream(spark, source), out, trigger=None, state_partitions=2, files_per_hour=1))
    assert keys(scan_layer(spark, out)) == keys(distinct_layers(spark.read.text(messages)))


def test_processing_time_trigger_and_default_checkpoint(spark, messages):
    out = shared_dir(spark, "out")
    job = start_layers(stream(spark, messages), out, trigger="1 second", state_partitions=2, files_per_hour=1)[0]
    job.processAllAvailable()
    assert job.isActive and job.name == "layers"
    job.stop()
    assert glob.glob(f"{out}_checkpoint/commits/*")
    assert keys(scan_layer(spark, out)) == keys(distinct_layers(spark.read.text(messages)))


def test_json_files_have_the_expected_form(spark, messages):
    out = shared_dir(spark, "out")
    write_layer(distinct_layers(spark.read.text(messages)).drop("branch"), out)
    files = glob.glob(f"{out}/year=2024/month=1/day=*/hour=*/*.json")
    assert files and not glob.glob(f"{out}/year=2024/month=01*")
    record = json.loads(open(files[0]).readline())
    assert set(record) <= {*READING_SCHEMA.fieldNames(), "ts"} and record["DeviceId"] >= 1
    assert record["ts"].endswith("Z") and len(record["ts"]) == len("2024-01-01T00:00:00.000Z")
    assert glob.glob(f"{out}/year=__HIVE_DEFAULT_PARTITION__/**/*.json", recursive=True)


def test_bounded_dedup_drops_copies_within_the_delay_and_forgets_later(spark, rows):
    path, out = shared_dir(spark, "source"), shared_dir(spark, "out")

    def reading(minute, value):
        at = f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00"
        return json.dumps(dict(time=at, DeviceId=1, sensor1=value, sensor2=1.0, sensor3=1.0, motor1=1.0, motor2=1.0,
                               motor3=1.0, isFail=False, collected_at=at))

    for batch in ([(0, 1.0), (5, 1.0)], [(7, 1.0)], [(300, 2.0)], [(310, 3.0)], [(311, 1.0)]):
        rows([(reading(*r),) for r in batch], "value string").coalesce(1).write.mode("append").text(path)
        with stateful_settings(spark, 2):
            job = write_layer(
                dedup_bounded(labelled_readings(stream(spark, path)), delay="1 hour"), out, trigger=None
            )
        job.awaitTermination()
    got = sorted((r["sensor1"], r["collected_at"]) for r in scan_layer(spark, *out.rsplit("/", 1), separate=True).collect())
    assert got == [(1.0, "2024-01-01T00:00:00"), (1.0, "2024-01-01T05:11:00"), (2.0, "2024-01-01T05:00:00"),
                   (3.0, "2024-01-01T05:10:00")]


def test_bounded_dedup_loses_no_reading_without_a_time(spark, rows):
    path, out = shared_dir(spark, "source"), shared_dir(spark, "out")

    def reading(at, value):
        return json.dumps(dict(DeviceId=1, sensor1=value, sensor2=1.0, sensor3=1.0, motor1=1.0, motor2=1.0, motor3=1.0,
                               isFail=False, collected_at=at))

    for batch in ([("bad", 1.0), ("bad", 1.0), ("2024-01-01T00:00:00", 2.0)], [("2024-01-01T05:00:00", 3.0)], [("bad", 5.0)]):
        rows([(reading(*r),) for r in batch], "value string").coalesce(1).write.mode("append").text(path)
        supervise(spark, start_layers(stream(spark, path), out, dedup="bounded", trigger=None, state_partitions=2))
    assert sorted(r["sensor1"] for r in scan_layer(spark, out).collect()) == [1.0, 2.0, 3.0, 5.0]


def test_copies_melt_within_a_task(spark, rows):
    from millrace.operators.dedup import melt_copies

    data = [(i % 3, 1.0 if i % 2 else float("nan"), None, i) for i in range(3000)]
    df = rows(data, "a int, b double, c string, n int").coalesce(1)
    got = melt_copies(df, ["a", "b", "c"])
    assert got.schema == df.schema
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 2, 3, 4, 5]


def test_window_counts_leave_out_late_rows(spark, rows):
    path, out = shared_dir(spark, "source"), shared_dir(spark, "out")
    schema = "DeviceId int, branch string, collected_at string"
    for batch in (["00:10", "00:50", "01:20"], ["03:00"], ["00:30", "03:10"], ["06:00"]):
        data = [(1, "fail", f"2024-01-01T{t}:00") for t in batch]
        rows(data, schema).coalesce(1).write.mode("append").parquet(path)
        df = event_time(stream_source(spark, "parquet", path, schema))
        with stateful_settings(spark, 2):
            job = (
                streaming_branch_counts(df, delay="10 minutes").writeStream.format("parquet")
                .option("checkpointLocation", f"{out}_c").trigger(availableNow=True).start(out)
            )
        job.awaitTermination()
    got = sorted((r["hour_start"].hour, r["readings"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (1, 1), (3, 2)]
    everything = event_time(spark.read.schema(schema).parquet(path))
    assert hourly_branch_counts(everything).filter("hour(hour_start) = 0").first()["readings"] == 3


def test_archive_pads_directories_and_keeps_records_whole(spark, rows):
    source, out = shared_dir(spark, "source"), shared_dir(spark, "archive")
    lines = ['{"a": 1, "unknown": [1, {"b": null}]}', '{"a":', "[1]"]
    rows([(v,) for v in lines], "value string").coalesce(1).write.text(source)
    archive_stream(stream(spark, source), out, trigger=None).awaitTermination()
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == sorted([lines[0], lines[2]])
    parts = glob.glob(f"{out}/year=*/month=*/day=*/hour=*")
    assert parts and all(len(p.rsplit("month=", 1)[1].split("/")[0]) == 2 for p in parts)


def test_scan_reads_padded_and_plain_directories_and_only_the_hours_asked_for(spark, rows, capsys):
    root = shared_dir(spark, "mixed")
    for month, hour, at in (("7", "3", "2024-07-05T03:30:00"), ("07", "04", "2024-07-05T04:30:00"), ("8", "4", "2024-08-05T04:30:00")):
        rows([(1, at)], "DeviceId int, collected_at string").coalesce(1).write.json(f"{root}/year=2024/month={month}/day=5/hour={hour}")
    hit = scan_layer(spark, *root.rsplit("/", 1), start="2024-07-05T03:00:00", end="2024-07-05T05:00:00", separate=True)
    assert sorted(r["hour"] for r in hit.collect()) == [3, 4]
    edge = scan_layer(spark, *root.rsplit("/", 1), start="2024-07-05T03:30:00", end="2024-07-05T04:30:00", separate=True)
    assert [r["hour"] for r in edge.collect()] == [3]
    edge.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(edge.inputFiles()) >= 1


def test_scan_of_nothing_is_empty_but_typed(spark):
    df = scan_layer(spark, shared_dir(spark, "never"), "fail", "2024-01-01", "2024-01-02")
    assert df.count() == 0 and "ts" in df.columns and df.schema["hour"].dataType.simpleString() == "int"


def report(batch, late=0):
    took = {"triggerExecution": 5} if batch == 2 else {"triggerExecution": 9, "addBatch": 7}
    state = SimpleNamespace(numRowsTotal=4, numRowsDroppedByWatermark=late)
    return SimpleNamespace(progress=SimpleNamespace(
        name="q", runId="r", batchId=batch, timestamp="2024-01-01T00:00:00.000Z", numInputRows=batch, durationMs=took,
        inputRowsPerSecond=1.0, processedRowsPerSecond=2.0, stateOperators=[state]))


def logged(spark, start, every=1):
    """The reports of the queries that ``start`` returns, run to their end."""
    path = shared_dir(spark, "reports")
    log = ProgressLog(spark, path, every)
    spark.streams.addListener(log)
    try:
        jobs = start()
        supervise(spark, jobs)
        log.wait(*jobs)
    finally:
        spark.streams.removeListener(log)
        log.close()
    return progress_frame(spark, path)


def test_progress_and_state(spark, messages):
    out = shared_dir(spark, "out")
    progress = logged(spark, lambda: start_layers(stream(spark, messages), out, trigger=None, state_partitions=2))
    assert progress.agg(F.sum("numInputRows")).first()[0] == spark.read.text(messages).count()
    held = state_metrics(progress).filter("metric = 'layers_states_rowsTotal'").agg(F.max("value")).first()[0]
    assert held == distinct_layers(spark.read.text(messages)).count()
    assert state_metrics(progress).filter("metric = 'layers_latency'").count() >= 1
    assert batch_latency_bands(progress).filter("band IS NULL").count() == 0


def test_every_batch_is_kept(spark, rows):
    """More batches than a query remembers of itself."""
    path = shared_dir(spark, "many")
    spark.range(160).selectExpr("string(id) AS value").coalesce(1).write.option("maxRecordsPerFile", 1).text(path)
    files = len(stream(spark, path).sparkSession.read.text(path).inputFiles())
    df = stream_source(spark, "text", path=path, schema="value string", maxFilesPerTrigger="1")

    def start():
        return [df.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "c")).trigger(availableNow=True).start()]

    progress = logged(spark, start, every=40)
    assert progress.agg(F.sum("numInputRows")).first()[0] == 160
    assert progress.filter("numInputRows > 0").select("batchId").distinct().count() == files > 150


def test_log_copes_with_batches_without_data(spark):
    log = ProgressLog(spark, shared_dir(spark, "reports"), every=2)
    assert progress_frame(spark, log.path).count() == 0
    log.follow(SimpleNamespace(runId="r"))
    for batch in range(3):
        log.onQueryProgress(report(batch, late=batch))
    log.onQueryTerminated(SimpleNamespace(id="i", runId="r", exception=None))
    log.wait(SimpleNamespace(runId="r"))
    got = progress_frame(spark, log.path).orderBy("batchId").collect()
    assert [(r["batchId"], r["addBatchMs"], r["stateRows"], r["lateRows"]) for r in got] == [(0, 7, 4, 0), (1, 7, 4, 1), (2, None, 4, 2)]
    with pytest.raises(TimeoutError):
        log.wait(SimpleNamespace(runId="other"), timeout=0.1)
    log.close()


def test_foreign_queries_leave_no_report(spark, messages):
    """Neither a run from before the log, nor one of another name beside it."""
    spark_stream = stream(spark, messages, maxFilesPerTrigger="1")

    def start(name, **pace):
        writer = spark_stream.writeStream.format("noop").queryName(name).option("checkpointLocation", shared_dir(spark, "c"))
        return writer.trigger(**pace).start()

    before = start("before", processingTime="100 milliseconds")
    log = ProgressLog(spark, shared_dir(spark, "reports"), names=["mine"])
    spark.streams.addListener(log)
    try:
        beside = start("beside", availableNow=True)
        mine = start("mine", availableNow=True)
        supervise(spark, [beside, mine])
        log.wait(mine)
    finally:
        before.stop()
        spark.streams.removeListener(log)
        log.close()
    got = progress_frame(spark, log.path)
    assert {(r["name"], r["runId"]) for r in got.collect()} == {("mine", str(mine.runId))}
    assert got.agg(F.sum("numInputRows")).first()[0] == spark.read.text(messages).count()


def test_reports_that_cannot_be_written_are_tried_again(spark, monkeypatch):
    log = ProgressLog(spark, shared_dir(spark, "reports"))
    monkeypatch.setattr(log, "AGAIN", 0.05)
    write, broken = log._write, threading.Event()

    def failing(rows):
        if broken.is_set():
            raise OSError("full")
        write(rows)

    monkeypatch.setattr(log, "_write", failing)
    broken.set()
    log.follow(SimpleNamespace(runId="r"))
    log.onQueryProgress(report(0))
    with pytest.raises(OSError):
        log.flush()
    broken.clear()
    log.onQueryProgress(report(1))
    log.onQueryTerminated(SimpleNamespace(id="i", runId="r", exception=None))
    log.close()
    assert sorted(r["batchId"] for r in progress_frame(spark, log.path).collect()) == [0, 1]


def test_dropped_rows_are_reported(spark, rows):
    """Unsorted input with a short delay loses readings, and says so."""
    path, out = shared_dir(spark, "source"), shared_dir(spark, "out")

    def reading(at, value):
        return json.dumps(dict(DeviceId=1, sensor1=value, sensor2=1.0, sensor3=1.0, motor1=1.0, motor2=1.0, motor3=1.0,
                               isFail=False, collected_at=at))

    late = 0
    for batch in ([("2024-01-01T05:00:00", 1.0)], [("2024-01-01T06:00:00", 2.0)], [("2024-01-01T01:00:00", 3.0)]):
        rows([(reading(*r),) for r in batch], "value string").coalesce(1).write.mode("append").text(path)
        progress = logged(
            spark, lambda: start_layers(stream(spark, path), out, dedup="bounded", delay="1 hour", trigger=None, state_partitions=2)
        )
        late += progress.agg(F.sum("lateRows")).first()[0]
    assert late == 1 and scan_layer(spark, out).count() == 2


def test_supervision_is_only_of_the_given_queries(spark, rows):
    path = shared_dir(spark, "source")
    rows([("x",)], "value string").write.text(path)
    df = stream(spark, path)

    def start(frame):
        return frame.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "c")).start()

    foreign = start(df.select(F.raise_error("broken").alias("e"), "value"))
    good = start(df)
    began = time.monotonic()
    supervise(spark, [good], timeout=3)
    assert good.isActive and time.monotonic() - began < 10
    bad = start(df.select(F.raise_error("broken").alias("e"), "value"))
    with pytest.raises(StreamingQueryException):
        supervise(spark, [good, bad], timeout=60)
    assert not good.isActive and not foreign.isActive
    spark.streams.resetTerminated()


def test_table_stream_leaves_its_neighbours_alone(spark, rows):
    root = shared_dir(spark, "tables")
    for name, n in (("events.parquet", 3), ("events.parquet_old", 5), ("events.parque", 7)):
        spark.range(n).write.parquet(f"{root}/{name}")
    df = table_stream(spark, f"{root}/events.parquet")
    out = shared_dir(spark, "out")
    df.writeStream.format("parquet").option("checkpointLocation", f"{out}_c").trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.schema(df.schema).parquet(out).count() == 3


def test_one_sided_scans_and_folders(spark, rows):
    root = shared_dir(spark, "layers")
    times = [f"2024-01-{d:02d}T{h:02d}:30:00" for d in (1, 2, 3) for h in (0, 9, 10, 23)]
    data = [(json.dumps(dict(DeviceId=1, sensor1=float(i), sensor2=1.0, sensor3=1.0, motor1=1.0, motor2=1.0, motor3=1.0,
                             isFail=False, collected_at=t)),) for i, t in enumerate(times)]
    write_layer(labelled_readings(rows(data, "value string")), root, partitions=("branch", "year", "month", "day", "hour"))

    def found(**bounds):
        return sorted(r["collected_at"] for r in scan_layer(spark, root, "data", **bounds).collect())

    assert found(start="2024-01-03") == times[8:]
    assert found(end="2024-01-01T09:30:00") == times[:1]
    two = dict(start="2024-01-02T09:00:00", end="2024-01-02T11:00:00")
    assert found(**two) == found(**two, by_folder=True) == times[5:7]
    assert found(start="2025-01-01", end="2025-01-02", by_folder=True) == []
    listed = scan_layer(spark, root, "data", **two, by_folder=True)
    files = listed._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().inputFiles()
    assert len(files) == 2
    with pytest.raises(ValueError):
        scan_layer(spark, root, separate=True)


def test_supervision_stops_the_others_when_one_fails(spark, rows):
    path = shared_dir(spark, "source")
    rows([("x",)], "value string").write.text(path)
    df = stream(spark, path)
    good = df.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "c")).start()
    bad = (
        df.select(F.raise_error("broken").alias("e"), "value").writeStream.format("noop")
        .option("checkpointLocation", shared_dir(spark, "c")).start()
    )
    with pytest.raises(StreamingQueryException):
        supervise(spark, [good, bad])
    assert not good.isActive and not bad.isActive
    spark.streams.resetTerminated()


def test_one_deduplication_in_the_streaming_plan(spark, messages):
    job = start_layers(stream(spark, messages), shared_dir(spark, "out"), trigger=None, state_partitions=2, files_per_hour=1)[0]
    job.awaitTermination()
    plan = job._jsq.explainInternal(False)
    assert plan.count("StreamingDeduplicate") == 1 and plan.count("from_json") == 1


def test_topic_source_defaults(spark, monkeypatch):
    seen = {}
    from millrace.sources import streams

    monkeypatch.setattr(streams, "stream_source", lambda spark, fmt, **o: seen.update(o))
    archive_source(spark, subscribe="t")
    assert seen == {"startingOffsets": "earliest", "subscribe": "t"}


def test_table_stream_reads_a_single_file_table(spark):
    df = table_stream(spark, EVENTS)
    assert df.isStreaming and df.columns == spark.read.parquet(EVENTS).columns


def test_feed_comes_by_time_and_every_hour_the_watermark_has_passed_is_counted(spark):
    """Of the hours of the table only those that end later than ten minutes before its last reading stay open."""
    got = stream_queries.streaming_window_count(spark, "/root/testdata/sf0.001")
    rows = labelled_readings(event_messages(spark.read.parquet(EVENTS))).filter("ts IS NOT NULL")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")
    until = rows.agg(F.date_trunc("millisecond", F.max("ts")) - F.expr("INTERVAL 70 MINUTES")).first()[0]
    want = rows.filter(F.date_trunc("hour", "ts") <= until).groupBy(hour, "DeviceId", "branch").agg(F.count("*").alias("readings"))
    columns = ["hour_start", "DeviceId", "branch", "readings"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_feed_lets_slices_of_time_in_one_after_the_other(spark):
    """Each batch holds a slice that is later than those before; nothing depends on the age of files."""
    feed = stream_queries.Feed(spark, "/root/testdata/sf0.001")
    seen = []
    job = (
        feed.events.writeStream.option("checkpointLocation", shared_dir(spark, "c"))
        .foreachBatch(lambda batch, _: seen.append(batch.agg(F.min("ts"), F.max("ts"), F.count("*")).first())).start()
    )
    feed.play(job)
    seen = [r for r in seen if r[2]]
    assert len(seen) == feed.slices == stream_queries.LEAST_BATCHES
    assert sum(r[2] for r in seen) == spark.read.parquet(EVENTS).count()
    assert all(a[1] <= b[0] for a, b in zip(seen, seen[1:])) and not job.isActive


def test_feed_has_events_without_a_time_and_batches_of_bounded_bytes(spark, monkeypatch):
    events, path = spark.read.parquet(EVENTS), shared_dir(spark, "tables")
    undated = F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("ts")
    events.select(*[undated if c == "ts" else c for c in events.columns]).write.parquet(f"{path}/events.parquet")
    got = stream_queries.progress_metrics(spark, path).first()
    batch = distinct_layers(event_messages(spark.read.parquet(f"{path}/events.parquet")))
    assert (got.input_rows, got.state_rows, got.late_rows) == (events.count(), batch.count(), 0)
    per_device = stream_queries.dedup_bounded(spark, path)
    assert sorted(map(tuple, per_device.collect())) == sorted(map(tuple, stream_queries.per_device(batch).collect()))
    monkeypatch.setitem(stream_queries.BATCH, "maxBytesPerTrigger", "1")  # of which every file is too large
    batches = stream_queries.layers_progress(spark, path).filter("numInputRows > 0")
    assert batches.count() == stream_queries.LEAST_FILES


def error_rows(seed, n=300):
    """Rows of three devices in disorder of up to two minutes, some of them on the minute; the second falls silent, the
    third comes back after hours."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        device, at = rnd.choice((1, 1, 2, 3)), rnd.choice([round(rnd.uniform(0, 400), 4), float(rnd.randrange(400))])
        if (device == 2 and at > 60) or (device == 3 and 20 < at < 300):
            continue
        out.append((device, datetime(2024, 1, 1) + timedelta(minutes=at)))
    return [*sorted(out, key=lambda r: r[1] + timedelta(seconds=rnd.uniform(0, 60))), (None, datetime(2024, 1, 1, 5)), (1, None)]


@pytest.mark.parametrize(("seed", "size", "every", "length"), [(1, 50, "1 minute", "1 hour"), (2, 300, "10 minutes", "30 minutes")])
def test_trailing_counts_equal_batch_at_every_instant(spark, rows, seed, size, every, length):
    data, schema = error_rows(seed), "DeviceId int, ts timestamp"
    path, out = shared_dir(spark, "source"), shared_dir(spark, "out")
    whole = rows(data, schema).schema
    for low in range(0, len(data), size):
        rows(data[low : low + size], schema).coalesce(1).write.mode("append").parquet(path)
        counts = streaming_error_counts(stream_source(spark, "parquet", path, whole), length, every, "2 minutes")
        job = counts.writeStream.format("parquet").option("checkpointLocation", f"{out}_c").trigger(availableNow=True).start(out)
        job.awaitTermination()
    got = {(r["as_of"], r["DeviceId"]): r["error_count"] for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count()
    step, span = (timedelta(seconds=micros(x) // 1_000_000) for x in (every, length))
    dated = [r for r in data if None not in r]
    until, want = max(r[1] for r in dated) - timedelta(minutes=2), {}
    at = datetime(2024, 1, 1)
    while at <= until:
        for device in (1, 2, 3):
            if n := sum(d == device and at - span <= t <= at for d, t in dated):
                want[at, device] = n
        at += step
    assert got == want
    for at in sorted({k[0] for k in want})[:: len(want) // 7]:
        batch = error_count_per_device(rows(dated, schema), at, length).collect()
        assert {(at, r["DeviceId"]): r["error_count"] for r in batch} == {k: n for k, n in got.items() if k[0] == at}


class Failure(Exception):
    pass


STAGES = ["written raw-data", "written fail", "written data", "indexed", "committed"]


@pytest.mark.parametrize("stage", STAGES)
def test_a_batch_that_fails_anywhere_leaves_each_row_once(spark, messages, stage):
    """Two of its batches fail at one stage, whatever is read in between is of whole batches."""
    out, failures = shared_dir(spark, "out"), {(stage, 0), (stage, 2)}
    batch = distinct_layers(spark.read.text(messages))

    def probe(*at):
        if at in failures:
            failures.remove(at)
            raise Failure(at)

    def start():
        return start_layers(
            stream(spark, messages, maxFilesPerTrigger="1"), out, separate=True, trigger=None, state_partitions=2,
            files_per_hour=1, probe=probe, merge=2,
        )[0]

    counts = []
    for _ in range(3):
        job = start()
        try:
            job.awaitTermination()
        except StreamingQueryException:
            pass
        parts = [scan_layer(spark, out, layer, separate=True).count() for layer in BRANCHES]
        counts.append(sum(parts))
        state = committed(spark, out)
        raw = 0 if state is None else scan_layer(spark, out, "raw-data", separate=True).count()
        assert raw == counts[-1]
    assert not failures and counts == sorted(counts) and counts[-1] == batch.count()
    for layer in BRANCHES:
        got = scan_layer(spark, out, layer, separate=True).withColumn("branch", F.lit(layer))
        assert keys(got) == keys(batch.filter(F.col("branch") == layer))
    start().awaitTermination()
    assert scan_layer(spark, out, "raw-data", separate=True).count() == batch.count()


@pytest.mark.parametrize("n", [2000, 3])
def test_batches_that_fail_are_of_many_files_and_there_are_two(spark, monkeypatch, n):
    """Each of the two batches is dealt to as many tasks as run at a time, if there are as many events."""
    sf_dir, seen = shared_dir(spark, "tables"), []
    ts = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1_000_000).cast("timestamp_ntz")
    spark.range(n).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 90 + F.col("id") / 1e6).alias("value"), F.lit('{"k": 5}').alias("props"),
    ).coalesce(1).write.parquet(f"{sf_dir}/events.parquet")

    def watched(spark, path, **options):
        seen.append((len(spark.read.parquet(path).inputFiles()), int(options["maxFilesPerTrigger"])))
        return table_stream(spark, path, **options)

    monkeypatch.setattr(stream_queries, "table_stream", watched)
    got = stream_queries.checkpoint_recovery_within_batch(spark, sf_dir)
    files, each = seen[0]
    assert set(seen) == {(files, each)} and each < files <= 2 * each
    assert n < 2000 or each >= spark.sparkContext.defaultParallelism
    want = distinct_layers(event_messages(spark.read.parquet(f"{sf_dir}/events.parquet"))).count()
    assert got.filter("layer = 'raw-data'").count() == got.filter("layer <> 'raw-data'").count() == want


@pytest.mark.parametrize("separate", [False, True])
def test_indexed_scan_opens_the_folders_of_its_hours_only(spark, rows, separate):
    """Two hours out of a thousand, written by a stream in several batches."""
    source, out = shared_dir(spark, "source"), shared_dir(spark, "out")
    times = [datetime(2024, 1, 1) + timedelta(hours=h, minutes=7) for h in range(1000)]
    data = [(json.dumps(dict(DeviceId=1, sensor1=float(h % 90), sensor2=float(h % 7), sensor3=float(h % 11), motor1=float(h), motor2=1.0,
                             motor3=1.0, isFail=False, collected_at=t.isoformat())),) for h, t in enumerate(times)]
    for low in range(0, 1000, 250):
        rows(data[low : low + 250], "value string").coalesce(1).write.mode("append").text(source)
    options = dict(separate=separate, committed=True, trigger=None, state_partitions=2, merge=3)
    start_layers(stream(spark, source, maxFilesPerTrigger="1"), out, **options)[0].awaitTermination()
    state = committed(spark, out)
    assert state["merged"] and len(state["loose"]) == 1
    for hour in (0, 333, 998):
        got = scan_layer(spark, out, "data", times[hour], times[hour] + timedelta(hours=2), separate=separate)
        assert sorted(r["collected_at"] for r in got.collect()) == [t.isoformat() for t in times[hour : hour + 2]]
        location = got._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location()
        assert 2 <= len(location.inputFiles()) <= 3 and location.rootPaths().size() <= 3
    assert scan_layer(spark, out, "data", separate=separate).count() == 1000
    assert scan_layer(spark, out, "data", "2030-01-01", "2030-01-02", separate=separate).count() == 0
    if not separate:
        assert scan_layer(spark, out, None, end=times[3]).count() == 3


def test_batches_of_two_checkpoints_share_a_root(spark, messages):
    out = shared_dir(spark, "out")
    for checkpoint in ("a", "b"):
        start_layers(stream(spark, messages), out, separate=True, trigger=None, state_partitions=2, checkpoint=f"{out}_{checkpoint}")[0].awaitTermination()
    batch = distinct_layers(spark.read.text(messages)).count()
    assert scan_layer(spark, out, "raw-data", separate=True).count() == 2 * batch


def test_failed_queries_are_started_again_a_bounded_number_of_times(spark, rows):
    path = shared_dir(spark, "source")
    rows([("x",)], "value string").write.text(path)
    started = []

    def starter(name, failures):
        checkpoint, out = shared_dir(spark, "c"), shared_dir(spark, "o")

        def start():
            started.append(name)
            broken = started.count(name) <= failures
            frame = stream(spark, path).select(F.raise_error(F.lit("broken")).cast("string").alias("value") if broken else "value")
            return frame.writeStream.format("text").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)

        return start, out

    (good, a), (flaky, b) = starter("good", 0), starter("flaky", 2)
    assert keep_running({"good": good, "flaky": flaky}, restarts=2, wait=0.05) == {"good": 0, "flaky": 2}
    assert spark.read.text(a).count() == spark.read.text(b).count() == 1
    endless = stream(spark, path).writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "c"))
    running = []

    def lasting():
        running.append(endless.start())
        return running[-1]

    with pytest.raises(StreamingQueryException):
        keep_running({"lasting": lasting, "bad": starter("bad", 9)[0]}, restarts=1, wait=0.05)
    assert started.count("bad") == 2 and len(running) == 1 and not running[0].isActive
    assert keep_running({"lasting": lasting}, timeout=1) == {"lasting": 0} and running[1].isActive
    running[1].stop()
    spark.streams.resetTerminated()
