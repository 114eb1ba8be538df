"""Equi-joins whose heavy keys are spread over several tasks.

Adaptive execution splits skewed join partitions at run time and is what a plain join relies on. ``spread_join`` does the
same ahead of time and for certain, for jobs in which one hub may own a large part of the edges: it counts the rows per
key with a map-side partial aggregate, cuts each heavy key into pieces of about ``rows_per_task`` rows, and repeats the
matching rows of the other side once per piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from propgraph.session import scratch_path

ROWS_PER_TASK = 1_000_000

# A list of heavy keys with more rows than this is joined instead of broadcast.
BROADCAST_KEYS = 50_000

PIECE, PIECES = "__piece", "__pieces"


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All keys with more than ``rows_per_task`` rows and the number of pieces to cut them into.

    The list is counted once and written to the shared folder, so that both sides of a join, and several jobs, see the same
    one. It has at most a row per ``rows_per_task`` rows of ``df``.
    """
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_task)
    heavy = counts.select(*keys, F.ceil(F.col("__n") / rows_per_task).cast("int").alias(PIECES))
    path, written = scratch_path(spark, "heavy-keys"), Observation()
    heavy.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
    stored = spark.read.schema(heavy.schema).parquet(path)
    return F.broadcast(stored) if (written.get["n"] or 0) <= BROADCAST_KEYS else stored


def cut_heavy(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Add the piece number to the side that is cut.

    It is a hash of the row and of the input partition: a retried task repeats it, and even rows that are copies of each
    other are spread if they come from several partitions.
    """
    others = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)
    ]
    piece = F.pmod(F.xxhash64(*(F.col(c) for c in others), F.spark_partition_id()), F.col(PIECES))
    return (
        df.join(heavy, list(keys), "left")
        .withColumn(PIECE, F.coalesce(piece, F.lit(0)).cast("int"))
        .drop(PIECES)
    )


def repeat_heavy(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Repeat the rows of heavy keys once per piece."""
    pieces = F.coalesce(F.col(PIECES), F.lit(1))
    return (
        df.join(heavy, list(keys), "left")
        .withColumn(PIECE, F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop(PIECES)
    )


def _written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back; as they are if a file cannot have them."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names) or "void" in df.schema.simpleString():
        return df
    path = scratch_path(df.sparkSession, "spread")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(
    many: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    many_rows: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` (hub keys possible) with ``other`` on equally named keys.

    ``how`` is inner, left or left_semi, seen from ``many``. If the number of rows of ``many`` is known and fits one task,
    no key can be heavy and the count is saved; it is also saved if the list ``heavy`` is given. Rows with a null key match
    nothing: in a left join they take no part in the join and are added, so that they are not one task either. Where keys are
    counted, ``many`` is written first: a chain of joins would else be run again for the count of each.
    """
    if heavy is None and (many_rows is None or many_rows > rows_per_task):
        many = _written(many)
        heavy = heavy_keys(many, keys, rows_per_task)
    if how == "left":
        known = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
        joined = spread_join(many.where(known), other, keys, "left_known", rows_per_task, many_rows, heavy)
        added = [F.lit(None).cast(f.dataType).alias(f.name) for f in joined.schema.fields if f.name not in many.columns]
        return joined.unionByName(many.where(~known).select(*many.columns, *added))
    how = "left" if how == "left_known" else how
    if many_rows is not None and many_rows <= rows_per_task:
        return many.join(other, list(keys), how)
    left = cut_heavy(many, keys, heavy)
    right = repeat_heavy(other, keys, heavy)
    return left.join(right, [*keys, PIECE], how).drop(PIECE)
