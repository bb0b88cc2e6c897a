"""What running queries report about themselves, kept as a table."""

from __future__ import annotations

import logging
import threading
from collections.abc import Collection

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "name string, runId string, batchId long, ts timestamp, numInputRows long, addBatchMs long, triggerMs long, "
    "inputRowsPerSecond double, processedRowsPerSecond double, stateRows long, lateRows long"
)
_KINDS = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "timestamp": pa.string()}
_REPORT = [(name, _KINDS[kind]) for name, kind in (part.split() for part in PROGRESS_SCHEMA.split(", "))]

log = logging.getLogger(__name__)


def _row(progress) -> tuple:
    """One report as a row. A batch without data has no addBatch time, a stateless query no state."""
    took = progress.durationMs
    return (
        progress.name,
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        took.get("addBatch"),
        took.get("triggerExecution"),
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        sum(op.numRowsTotal for op in progress.stateOperators),
        sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
    )


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches reported so far to the :class:`ProgressLog` at ``path``; rows that came too late and were
    dropped are in ``lateRows``."""
    try:
        return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS_SCHEMA)


def state_metrics(progress: DataFrame) -> DataFrame:
    """Progress as metric samples: ``<query>_latency`` in ms, ``<query>_input_rows``, ``<query>_late_rows`` and
    ``<query>_states_rowsTotal``.

    The last counts distinct readings held, so its growth is not throughput; input rows are.
    """
    wide = progress.select(
        F.coalesce("name", F.lit("query")).alias("name"),
        "ts",
        F.col("triggerMs").cast("double").alias("latency"),
        F.col("numInputRows").cast("double").alias("input_rows"),
        F.col("lateRows").cast("double").alias("late_rows"),
        F.col("stateRows").cast("double").alias("states_rowsTotal"),
    )
    kinds = ["latency", "input_rows", "late_rows", "states_rowsTotal"]
    long = wide.unpivot(["name", "ts"], kinds, "kind", "value")
    return long.filter("value IS NOT NULL").select(
        F.concat_ws("_", "name", "kind").alias("metric"), "name", "ts", "value"
    )


class ProgressLog(StreamingQueryListener):
    """Logs each micro-batch and appends its report to a table at ``path``, in the folder that all executors share.

    Only runs that start while the log is registered are reported, and of those, if ``names`` are given, only queries of
    these names; :meth:`follow` adds one that runs already. A callback does no more than take a report in: a thread of
    the log's own writes ``every`` reports together, and what is left when a query ends. Nothing is forgotten, however
    many batches there are; reports that cannot be written wait and are tried again. Register it before the queries
    start, ``spark.streams.addListener(log)``, and :meth:`close` it in the end.
    """

    #: Seconds until a failed write is tried again.
    AGAIN = 1.0

    def __init__(self, spark: SparkSession, path: str, every: int = 1, names: Collection[str] | None = None):
        self.spark, self.path, self.every, self.names = spark, path, every, names
        self._change = threading.Condition()
        self._waiting: list[tuple] = []
        self._runs: set[str] = set()
        self._ended: set[str] = set()
        self._due = self._closed = False
        self._failure: Exception | None = None
        self._writer: threading.Thread | None = None

    def follow(self, *queries: StreamingQuery) -> None:
        """Take reports of these runs as well, from now on."""
        with self._change:
            self._runs.update(str(query.runId) for query in queries)

    def _write(self, rows: list[tuple]) -> None:
        held = pa.table({name: pa.array([row[k] for row in rows], kind) for k, (name, kind) in enumerate(_REPORT)})
        typed = self.spark.createDataFrame(held).withColumn("ts", F.col("ts").try_cast("timestamp"))
        typed.coalesce(1).write.mode("append").parquet(self.path)

    def _work(self) -> None:
        while True:
            with self._change:
                self._change.wait_for(lambda: len(self._waiting) >= self.every or self._due or self._closed)
                rows = list(self._waiting)
                if not rows:
                    self._due = False
                    self._change.notify_all()
                    if self._closed:
                        return
                    continue
            try:
                self._write(rows)
            except Exception as failure:  # noqa: BLE001 - told to whoever waits
                log.exception("reports could not be written to %s", self.path)
                with self._change:
                    self._failure = failure
                    self._change.notify_all()
                    if self._closed:
                        return
                    self._change.wait(self.AGAIN)
                continue
            with self._change:
                del self._waiting[: len(rows)]
                self._failure = None
                self._change.notify_all()

    def _wake(self) -> None:
        if self._writer is None:
            self._writer = threading.Thread(target=self._work, name="progress-log", daemon=True)
            self._writer.start()
        self._change.notify_all()

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)
        if self.names is None or event.name in self.names:
            with self._change:
                self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        row = _row(event.progress)
        with self._change:
            if row[1] not in self._runs:
                return
            self._waiting.append(row)
            self._wake()
        log.info("query %s: %s rows, %s ms, %s rows/s", row[0], row[4], row[6], row[8])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended %s", event.id, event.exception or "")
        with self._change:
            if str(event.runId) in self._runs:
                self._ended.add(str(event.runId))
                self._due = True
                self._wake()

    def flush(self, timeout: float = 60) -> None:
        """Until all reports taken in so far are written."""
        with self._change:
            self._due = True
            self._wake()
            if not self._change.wait_for(lambda: not self._waiting or self._failure, timeout):
                raise TimeoutError(f"{len(self._waiting)} reports not written in {timeout} s")
            if self._failure:
                raise self._failure

    def wait(self, *queries: StreamingQuery, timeout: float = 60) -> None:
        """Until the end of the queries has been reported, and so all of their batches, and all is written; reports
        arrive later than the batches end."""
        runs = {str(query.runId) for query in queries}
        with self._change:
            if not self._change.wait_for(lambda: runs <= self._ended, timeout):
                raise TimeoutError(f"no report of the end of {runs - self._ended} in {timeout} s")
        self.flush(timeout)

    def close(self) -> None:
        """Write what is left and end the thread."""
        with self._change:
            self._closed = True
            self._change.notify_all()
        if self._writer is not None:
            self._writer.join()
