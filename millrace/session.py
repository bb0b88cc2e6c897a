"""Session settings and the shared folder for written tables and checkpoints."""

from __future__ import annotations

import re
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_utc(spark: SparkSession) -> SparkSession:
    """Readings carry zone-less ISO times; every session reads them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, tables go below the session's warehouse, if that is shared as well: on a cluster it may not be
    a folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"
        place = spark._jvm.org.apache.hadoop.fs.Path(root)
        scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
        if scheme == "file" and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{root} is a folder of one machine; name a shared one in spark.checkpoint.dir")
    return f"{root.rstrip('/')}/{label}-{uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stateful_settings(spark: SparkSession, state_partitions: int | None = None):
    """Settings a stateful query takes over when it starts.

    State lives in RocksDB, so that it may outgrow executor memory. The number of state partitions is
    fixed by the first checkpoint, so it is set here rather than left to whatever the session has.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    return settings(spark, wanted)
