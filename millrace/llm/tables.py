"""Written tables in the folder all executors share: they cut lineage and survive the loss of an executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.session import settings, shared_dir

#: Rows of an Arrow batch while a table is written; with whole texts or sets in a row, the default of 10,000 would take
#: as much memory as a worker has.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again, so that it is computed once."""
    path = shared_dir(df.sparkSession, label)
    with settings(df.sparkSession, BATCH):
        df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no frame in use reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
