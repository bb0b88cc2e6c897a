"""Record layout, valid ranges and display limits, each stated once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: field names, types, ranges and limits that results depend on ---

READING_SCHEMA = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("DeviceId", T.IntegerType()),
        T.StructField("sensor1", T.DoubleType()),
        T.StructField("sensor2", T.DoubleType()),
        T.StructField("sensor3", T.DoubleType()),
        T.StructField("motor1", T.DoubleType()),
        T.StructField("motor2", T.DoubleType()),
        T.StructField("motor3", T.DoubleType()),
        T.StructField("isFail", T.BooleanType()),
        T.StructField("collected_at", T.StringType()),
    ]
)

MEASURES = ("sensor1", "sensor2", "sensor3", "motor1", "motor2", "motor3")
REQUIRED = (*MEASURES, "isFail", "DeviceId", "collected_at")
DEDUP_KEYS = ("DeviceId", *MEASURES, "isFail")
PARTITIONS = ("year", "month", "day", "hour")
BRANCHES = ("fail", "dataerr", "data")

MEASURE_LIMITS = {
    "sensor1": (0, 100),
    "sensor2": (0, 100),
    "sensor3": (0, 150),
    "motor1": (0, 2000),
    "motor2": (0, 1500),
    "motor3": (0, 1800),
}
ACCEPTED_DEVICES = (1, 100)
DOCUMENTED_DEVICES = (1, 5)

# A step is (lower bound, colour); None is the base step. The highest step reached wins.
GAUGE_STEPS = {
    "sensor1": ((None, "red"), (0, "green"), (90, "red")),
    "sensor2": ((None, "red"), (0, "green"), (90, "red")),
    "sensor3": ((None, "red"), (0, "green"), (130, "red")),
    "motor1": ((None, "red"), (0, "green"), (1900, "red")),
    "motor2": ((None, "red"), (0, "green"), (1400, "red")),
    "motor3": ((None, "red"), (0, "green"), (1900, "red")),
}
ERROR_COUNT_STEPS = ((None, "green"), (80, "red"))
LATENCY_STEPS = ((None, "green"), (7000, "red"))

ERROR_ALERT_LIMIT = 90
MEMORY_ALERT_LIMIT = 75
ALERT_EVERY = "1 minute"
ALERT_FOR = "1 minute"
ALERT_KEEP_FIRING = "30 seconds"
ALERT_LOOKBACK = "600 seconds"
TRIGGER = "30 seconds"

# --- End of fixed values ---


@dataclass(frozen=True)
class Ranges:
    """Inclusive bounds per column; the conjunction decides whether a reading is plausible."""

    measures: Mapping[str, tuple[float, float]]
    devices: tuple[int, int]

    def items(self) -> list[tuple[str, tuple[float, float]]]:
        return [*self.measures.items(), ("DeviceId", self.devices)]


DEFAULT_RANGES = Ranges(MEASURE_LIMITS, ACCEPTED_DEVICES)
DOCUMENTED_RANGES = Ranges(MEASURE_LIMITS, DOCUMENTED_DEVICES)
