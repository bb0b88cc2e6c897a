"""Lines, words, partition layout and the file sinks, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.tokens import words_any_space
from millrace.operators import words
from millrace.plans import monitors
from millrace.plans.reading_queries import _LATEST, AS_OF, layers
from millrace.plans.registry import FIELDS, MEASURED, TO_LAYERS, query, table, with_
from millrace.schema import PARTITIONS
from millrace.session import shared_dir
from millrace.sinks.layers import write_layer
from millrace.sinks.text import current_snapshot, read_snapshot, write_exposition, write_kv, write_lines, write_snapshot
from millrace.sources.files import partition_report, read_lines
from millrace.sources.layers import scan_layer

# White space as the two splits see it, for an engine without Unicode classes.
ANY_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
ASCII_SPACE = r"[\x09-\x0d\x20]+"

LINES = r"""lines AS (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS value FROM documents)"""


def texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def lines(spark, sf_dir):
    return texts(spark, sf_dir).select(F.explode(F.split("value", r"\r\n|\r|\n")).alias("value"))


@query("text_lines", with_(LINES, body="SELECT value FROM lines"))
def text_lines(spark, sf_dir):
    path = shared_dir(spark, "text-lines")
    write_lines(texts(spark, sf_dir), path)
    return read_lines(spark, path)


@query(
    "range_repartition",
    "SELECT count(*) AS rows, CAST(3 AS BIGINT) AS partitions, true AS even FROM events",
)
def range_repartition(spark, sf_dir):
    """Sizes per partition vary with the input splits, so totals are shown."""
    events = table(spark, sf_dir, "events")
    spread = F.max("row_count") - F.min("row_count") <= 0.01 * F.sum("row_count") + 64
    return partition_report(events, 3).agg(
        F.sum("row_count").alias("rows"), F.count("*").alias("partitions"), spread.alias("even")
    )


@query(
    "word_split_ws",
    f"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '{ANY_SPACE}'), lambda w: w <> ''), chr(31)) AS words
        FROM documents""",
)
def word_split_ws(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.array_join(words_any_space(F.col("text")), "\x1f").alias("words"))


@query(
    "word_count",
    with_(
        f"words AS (SELECT unnest(regexp_split_to_array(text, '{ANY_SPACE}')) AS word FROM documents)",
        body="SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word",
    ),
)
def word_count(spark, sf_dir):
    return words.word_count(words.word_split_ws(texts(spark, sf_dir)))


_JAVA_WORDS = f"""words AS (
  SELECT unnest(CASE WHEN value = '' THEN ['']
                     WHEN regexp_full_match(value, '{ASCII_SPACE}') THEN []
                     ELSE regexp_split_to_array(regexp_replace(value, '{ASCII_SPACE}$', ''), '{ASCII_SPACE}')
                END) AS word
  FROM lines)"""


@query(
    "word_split_java",
    with_(LINES, _JAVA_WORDS, body="SELECT word, count(*) AS n FROM words GROUP BY word"),
)
def word_split_java(spark, sf_dir):
    return words.word_count(words.word_split_java(lines(spark, sf_dir)))


@query(
    "text_kv_sink",
    with_(
        LINES,
        _JAVA_WORDS,
        body="SELECT word || chr(9) || count(*) AS value FROM words GROUP BY word",
    ),
)
def text_kv_sink(spark, sf_dir):
    path = shared_dir(spark, "word-count")
    write_kv(word_split_java(spark, sf_dir), path)
    return read_lines(spark, path)


_BACK = f"""SELECT {FIELDS}, branch, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                   CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, ts FROM layers"""


def written(spark, sf_dir) -> str:
    """Path of the layers of all messages, written as one batch."""
    path = shared_dir(spark, "layers")
    write_layer(layers(spark, sf_dir), path, partitions=("branch", *PARTITIONS), least_share="64k")
    return path


@query("partitioned_sink", with_(*TO_LAYERS, body=_BACK))
def partitioned_sink(spark, sf_dir):
    return scan_layer(spark, written(spark, sf_dir))


@query(
    "partition_scan",
    with_(
        *TO_LAYERS,
        body=_BACK + """ WHERE branch = 'data' AND ts >= TIMESTAMP '2024-01-15 09:30:00'
                         AND ts < TIMESTAMP '2024-01-17 12:00:00'""",
    ),
)
def partition_scan(spark, sf_dir):
    path = written(spark, sf_dir)
    return scan_layer(spark, path, "data", "2024-01-15 09:30:00", "2024-01-17 12:00:00", by_folder=True)


@query(
    "missing_partition_as_empty",
    with_(*TO_LAYERS, body=_BACK + " WHERE branch = 'fail' AND ts >= TIMESTAMP '2024-01-29'"),
)
def missing_partition_as_empty(spark, sf_dir):
    """A range that runs on past the last hour, and a layer that was never written."""
    path = written(spark, sf_dir)
    fail = scan_layer(spark, path, "fail", "2024-01-29", "2024-06-01", by_folder=True)
    return fail.unionByName(scan_layer(spark, f"{path}-none", "fail", "2024-01-29", "2024-06-01"))


@query(
    "monitor_layer",
    with_(
        *TO_LAYERS,
        _LATEST.replace(
            "branch = 'data'",
            "branch = 'data' AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'",
        ),
        body=f"""SELECT metric, device_id, value FROM (
                   SELECT CAST(DeviceId AS VARCHAR) AS device_id, {MEASURED} FROM latest)
                 UNPIVOT (value FOR metric IN ({MEASURED}))""",
    ),
)
def monitor_layer(spark, sf_dir):
    return monitors.monitor_layer(spark, written(spark, sf_dir), "data", "2024-01-15", "2024-01-16")


_ERROR_GAUGE = f"""SELECT 'error_count_per_hour' AS metric, CAST(DeviceId AS VARCHAR) AS device_id,
                          CAST(count(*) AS DOUBLE) AS value
                   FROM layers WHERE branch = 'dataerr' AND ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR
                   AND TIMESTAMP '{AS_OF}' GROUP BY ALL"""


@query("gauge_snapshot_replace", with_(*TO_LAYERS, body=_ERROR_GAUGE))
def gauge_snapshot_replace(spark, sf_dir):
    """A first snapshot is replaced by the one of a later time; only the later one is left."""
    path = shared_dir(spark, "snapshot")
    errors = layers(spark, sf_dir).filter("branch = 'dataerr'")
    write_snapshot(monitors.error_metrics(errors, "2024-01-10 08:00:00"), path)
    write_snapshot(monitors.error_metrics(errors, AS_OF), path)
    return read_snapshot(spark, path)


@query(
    "exposition_file",
    with_(
        *TO_LAYERS,
        _LATEST,
        body=f"""SELECT 'latest_' || metric || '{{device_id="' || device_id || '"}} ' || CAST(value AS VARCHAR) AS value
                 FROM (SELECT CAST(DeviceId AS VARCHAR) AS device_id, {MEASURED} FROM latest)
                 UNPIVOT (value FOR metric IN ({MEASURED}))""",
    ),
)
def exposition_file(spark, sf_dir):
    path = shared_dir(spark, "exposition")
    data = layers(spark, sf_dir).filter("branch = 'data'")
    write_exposition(monitors.latest_metrics(data, "latest_"), path)
    return read_lines(spark, current_snapshot(spark, path))
