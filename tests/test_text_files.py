from __future__ import annotations

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.tokens import words_any_space, words_ascii_space
from millrace.operators.words import word_count, word_split_java, word_split_ws
from millrace.session import shared_dir
from millrace.sinks.pointer import folders, pointed, swap
from millrace.sinks.text import current_snapshot, read_snapshot, write_exposition, write_kv, write_snapshot
from millrace.sources.files import partition_report, read_lines

LINES = [
    "", " ", "   ", " a  b ", "a", "a\tb c", "　x y", "a\x0bb\x0cc\x1cd\x1fe\x85f", " a b c d ",
    "zero​width", "\n a \r\n b",
]


def java_split(line: str) -> list[str]:
    """Pieces between runs of ASCII white space as documented for the JVM's split: trailing empties go."""
    import re

    if line == "":
        return [""]
    pieces = re.split("[ \t\n\x0b\f\r]+", line)
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


def test_unicode_split_equals_python(rows):
    df = rows([(v,) for v in LINES], "value string")
    assert [r[0] for r in df.select(words_any_space(F.col("value"))).collect()] == [v.split() for v in LINES]


def test_ascii_split_keeps_a_leading_empty_piece(rows):
    df = rows([(v,) for v in LINES], "value string")
    got = [r[0] for r in df.select(words_ascii_space(F.col("value"))).collect()]
    assert got == [java_split(v) for v in LINES]
    assert got[:4] == [[""], [], [], ["", "a", "b"]]


def test_word_counts(rows):
    df = rows([("the cat and the dog",), (" the end ",)], "value string")
    assert {r["word"]: r["n"] for r in word_count(word_split_ws(df)).collect()} == {
        "the": 3, "cat": 1, "and": 1, "dog": 1, "end": 1,
    }
    assert {r["word"]: r["n"] for r in word_count(word_split_java(df)).collect()}[""] == 1


def test_counts_as_text(spark, rows):
    path = shared_dir(spark, "kv")
    write_kv(rows([("a", 2), ("", 1)], "word string, n long"), path)
    assert sorted(r["value"] for r in read_lines(spark, path).collect()) == ["\t1", "a\t2"]


def test_snapshot_forgets_absent_devices_and_clears_on_empty(spark, rows):
    path, schema = shared_dir(spark, "snap"), "metric string, device_id string, value double"
    write_snapshot(rows([("m", "1", 1.0), ("m", "2", 2.0)], schema), path)
    write_snapshot(rows([("m", "2", 3.0)], schema), path)
    assert [tuple(r) for r in read_snapshot(spark, path).collect()] == [("m", "2", 3.0)]
    write_snapshot(rows([], schema), path)
    assert read_snapshot(spark, path).count() == 0
    lines = shared_dir(spark, "lines")
    write_exposition(rows([("m", "1", 5.0)], schema), lines)
    assert read_lines(spark, current_snapshot(spark, lines)).first()["value"] == 'm{device_id="1"} 5.0'


def test_a_reader_finds_a_whole_snapshot_at_any_time(spark, rows):
    """Snapshots whose rows all have the number of the snapshot, read while they are replaced."""
    path = shared_dir(spark, "snap")

    def snapshot(k):
        return spark.range(0, 500, 1, 3).select(F.lit("m").alias("metric"), F.col("id").cast("string").alias("device_id"), F.lit(float(k)).alias("value"))

    write_snapshot(snapshot(0), path)
    done, seen, failures = threading.Event(), [], []

    def look():
        while not done.is_set():
            try:
                seen.append(read_snapshot(spark, path).groupBy("value").count().collect())
            except Exception as failure:  # noqa: BLE001
                failures.append(failure)

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(1, 9):
        write_snapshot(snapshot(k), path, former=3)
    done.set()
    reader.join()
    assert not failures and len(seen) > 2
    assert all(len(found) == 1 and found[0]["count"] == 500 for found in seen)
    assert [found[0]["value"] for found in seen] == sorted(found[0]["value"] for found in seen)
    assert len(folders(spark, path, "version-")) == 4


def test_a_failed_write_leaves_the_last_snapshot(spark, rows):
    path, schema = shared_dir(spark, "snap"), "metric string, device_id string, value double"
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    write_snapshot(rows([("m", "1", 1.0)], schema), path)
    broken = spark.range(9).select(F.lit("m").alias("metric"), F.raise_error(F.lit("broken")).cast("string").alias("device_id"), F.lit(2.0).alias("value"))
    with pytest.raises(PySparkException):
        write_snapshot(broken, path)
    assert [tuple(r) for r in read_snapshot(spark, path).collect()] == [("m", "1", 1.0)]
    write_snapshot(rows([("m", "1", 3.0)], schema), path, former=0)
    assert read_snapshot(spark, path).first()["value"] == 3.0 and len(folders(spark, path, "version-")) == 1


def test_swapped_files(spark):
    path = f"{shared_dir(spark, 'pointer')}/_current"
    assert pointed(spark, path) is None
    for text in ("one", "zwei ü", ""):
        swap(spark, path, text)
        assert pointed(spark, path) == text


def test_partition_report_spreads_rows_evenly(spark):
    got = partition_report(spark.range(0, 1000, 1, 7), 3).orderBy("partition").collect()
    assert [r["partition"] for r in got] == [0, 1, 2]
    assert sum(r["row_count"] for r in got) == 1000 and all(abs(r["row_count"] - 333) <= 7 for r in got)
