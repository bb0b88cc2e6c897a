"""From message bytes to typed readings. Everything here works on batch and on streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.checks import is_json
from millrace.functions.clock import as_timestamp, instant, iso
from millrace.schema import MEASURES, READING_SCHEMA


def value_as_string(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"))


def decoded(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON in ``value`` as the columns of ``schema``, parsed once per record.

    As a plain projection, every later filter on one of the fields would be pushed below it together with
    a parser of its own: nine required fields, nine more passes over the text. The fields of a generator
    stay where they are.
    """
    return df.select(*keep, F.inline(F.array(F.from_json("value", schema))))


def text_schema(schema: T.StructType = READING_SCHEMA) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def parse_reading(
    df: DataFrame,
    schema: T.StructType = READING_SCHEMA,
    coerce: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode ``value`` into the reading columns; what does not decode is null.

    A field of the wrong JSON type is null. With ``coerce`` each field is read as text first and then
    cast, so that ``"1.5"`` becomes 1.5. ``keep`` passes other message columns through.
    """
    if not coerce:
        return decoded(df, schema, keep)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return decoded(df, text_schema(schema), keep).select(*keep, *typed)


def json_valid_records(df: DataFrame, col: str = "value") -> DataFrame:
    """Keep the records that are one JSON document, untouched."""
    return df.filter(is_json(F.col(col)))


def stamp_collected_at(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the collection time as ISO text: the given time, else the time the query runs."""
    return df.withColumn("collected_at", iso(F.current_timestamp() if at is None else instant(at)))


def event_time(df: DataFrame, src: str = "collected_at", on_bad_ts: str = "null") -> DataFrame:
    """``ts`` from ISO text. Text that is no time gives null, or with ``on_bad_ts="reject"`` no row."""
    if on_bad_ts not in ("null", "reject"):
        raise ValueError(f"on_bad_ts must be null or reject, not {on_bad_ts}")
    out = df.withColumn("ts", as_timestamp(F.col(src)))
    return out.filter(F.col("ts").isNotNull()) if on_bad_ts == "reject" else out


def time_partitions(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}
    )


def zero_pad_partitions(df: DataFrame, ts: str | Column = "ts") -> DataFrame:
    """The same four columns as text of fixed width, plus the stamp used in archive file names."""
    forms = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "stamp": "yyyyMMdd_HHmmss"}
    return df.withColumns({name: F.date_format(ts, form) for name, form in forms.items()})


def project_metrics(df: DataFrame) -> DataFrame:
    return df.select("DeviceId", *MEASURES)


def write_records(
    records: DataFrame, fmt: str = "kafka", path: str | None = None, checkpoint: str | None = None, **options: str
) -> StreamingQuery | None:
    """Send ``key`` and ``value`` of :func:`encode_records` to a topic, or with another format and a path to files.

    A batch is sent at once; a stream starts a query that sends what arrives.
    """
    if not records.isStreaming:
        writer = records.write.format(fmt).mode("append").options(**options)
        writer.save(path) if path else writer.save()
        return None
    sink = records.writeStream.format(fmt).outputMode("append").options(**options)
    sink = sink.option("checkpointLocation", checkpoint) if checkpoint else sink
    return sink.start(path) if path else sink.start()


def encode_records(df: DataFrame) -> DataFrame:
    """Message form: the device id as key, the whole record as JSON value."""
    return df.select(
        F.col("DeviceId").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
    )
