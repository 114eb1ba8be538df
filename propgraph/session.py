"""Scratch space and file-system helpers shared by the jobs that write tables.

Intermediate tables go to the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local session without
that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="propgraph-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for one intermediate table."""
    return f"{scratch_root(spark)}/propgraph/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder and what is below it; False if there was none."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.delete(hadoop_path, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text; False if there is one of that name already, which stays as it is.

    The text is written under another name and renamed, so a reader sees all of it or no file, and a writer that dies
    leaves the name free.
    """
    fs, target = _hadoop_path(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    option = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(temporary, target, spark.sparkContext._gateway.new_array(option, 0))
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is no such file."""
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized_partitions(
    spark: SparkSession, rows: int, rows_per_partition: int = 50_000, most_per_partition: int = 2_000_000
) -> int:
    """Partitions for ``rows`` rows: what ``spark`` sets where it gives partitions between ``rows_per_partition`` and
    ``most_per_partition`` rows; else fewer, or more."""
    fewest, enough = -(-rows // most_per_partition), max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition))
    return max(fewest, min(enough, shuffle_partitions(spark)))


def sized_session(
    spark: SparkSession, rows: int, rows_per_partition: int = 50_000, most_per_partition: int = 2_000_000
) -> SparkSession:
    """A session for a job over ``rows`` rows, with as many shuffle partitions as the rows need.

    An iterative job that keeps a partitioning cannot leave this to adaptive execution. The setting of ``spark`` holds where
    it gives partitions between ``rows_per_partition`` and ``most_per_partition`` rows; else there are fewer, or more. It is
    not changed itself; its other settings are taken over.
    """
    enough = sized_partitions(spark, rows, rows_per_partition, most_per_partition)
    if enough == shuffle_partitions(spark):
        return spark
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", str(enough))
    return session
