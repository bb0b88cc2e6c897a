"""Keep incoming messages as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.parse import json_valid_records, value_as_string, zero_pad_partitions
from millrace.schema import PARTITIONS, TRIGGER
from millrace.sinks.layers import write_layer


def archive_stream(
    messages: DataFrame,
    path: str,
    trigger: str | None = TRIGGER,
    checkpoint: str | None = None,
    name: str = "archive",
) -> StreamingQuery:
    """Append every message that is JSON, one per line, under the hour it was processed in (zero-padded).

    Offsets move on only with the files they stand for, so nothing is lost when a write fails.
    """
    lines = json_valid_records(value_as_string(messages)).withColumn("_now", F.current_timestamp())
    dated = zero_pad_partitions(lines, "_now").select("value", *PARTITIONS)
    return write_layer(dated, path, name, trigger, "text", PARTITIONS, checkpoint)
