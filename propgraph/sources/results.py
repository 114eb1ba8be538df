"""Hand results over: as partitions of a given number, or as a saved table that is read back in parallel."""

from __future__ import annotations

from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.session import scratch_path


def with_parallelism(df: DataFrame, parallelism: int | None = None) -> DataFrame:
    """The result in ``parallelism`` partitions, at least one; without a number it keeps the partitions it has. Rows move
    between executors, never through the driver."""
    return df if parallelism is None else df.repartition(max(1, parallelism))


def to_rdd(df: DataFrame, parallelism: int | None = None) -> RDD:
    """The result as an RDD of rows, for programs that need one."""
    return with_parallelism(df, parallelism).rdd


def save_result(df: DataFrame, path: str | None = None) -> str:
    """Save a large result as Parquet and return its path (a new one below the shared scratch folder by default)."""
    path = path or scratch_path(df.sparkSession, "result")
    df.write.parquet(path)
    return path


def spill(df: DataFrame, path: str | None = None) -> DataFrame:
    """Save a large result and read it back in parallel."""
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(save_result(df, path))


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per partition, ``partition_id, n``."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n"))
