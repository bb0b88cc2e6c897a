"""Plain text and partition layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def partition_report(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows evenly over ``partitions`` partitions and count them per partition."""
    return (
        df.repartition(partitions)
        .groupBy(F.spark_partition_id().alias("partition"))
        .agg(F.count("*").alias("row_count"))
    )
