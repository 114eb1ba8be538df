"""Packed keys for the vertices of a stored graph: a dictionary from (label, uid) to a number that loads extend.

    <path>/<n>.json                                        the parts of generation n, and the table buckets they cover
    <path>/part=<n>-<id>/label_index=<i>/__bucket=<shard>  uids that were new in generation n, with their inner ids

A vertex is in the shard that its bucket in the stored graph is; inner ids count up within a label and shard, so shard, label
index and inner id make a version 18 key. A number is given once and stays.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from propgraph.functions import keys as K
from propgraph.operators.skew import ROWS_PER_TASK, spread_join
from propgraph.session import child_names, delete_path, read_text, scratch_path, write_once
from propgraph.storage import BUCKET, StoredGraph, bucket_of

ENTRIES = f"uid string, inner bigint, label_index int, {BUCKET} int"


@dataclass(frozen=True)
class VertexNumbers:
    """One generation of a dictionary. ``covered``: label -> bucket -> version of the table it has numbers for."""

    spark: SparkSession
    path: str
    generation: int
    parts: tuple[str, ...]
    covered: Mapping[str, Mapping[str, str]]
    labels: Mapping[str, int]

    @staticmethod
    def open(spark: SparkSession, path: str) -> VertexNumbers:
        """The newest generation; an empty one if there is none."""
        path = path.rstrip("/")
        names = (re.fullmatch(r"(\d+)\.json", name) for name in child_names(spark, path))
        newest = max((int(name[1]) for name in names if name), default=0)
        if not newest:
            return VertexNumbers(spark, path, 0, (), {}, {})
        note = json.loads(read_text(spark, f"{path}/{newest}.json"))
        return VertexNumbers(spark, path, newest, tuple(note["parts"]), note["covered"], note["labels"])

    def entries(self) -> DataFrame:
        """``uid, inner, label_index, __bucket`` as they are stored; label and bucket are folders, so filters on them prune."""
        if not self.parts:
            return self.spark.createDataFrame([], ENTRIES)
        stored = self.spark.read.schema(f"{ENTRIES}, part string").option("basePath", self.path)
        return stored.parquet(*(f"{self.path}/part={part}" for part in self.parts)).drop("part")

    def table(self) -> DataFrame:
        """``label, label_index, uid, shard, inner``, the key as a 64-bit ``number`` and, as text, ``rk``."""
        parts = F.col(BUCKET), F.col("label_index"), F.col("inner")
        names = [F.when(F.col("label_index") == i, F.lit(label)) for label, i in self.labels.items()]
        return self.entries().select(
            F.coalesce(*names, F.lit(None).cast("string")).alias("label"),
            "label_index",
            "uid",
            F.col(BUCKET).alias("shard"),
            "inner",
            K.packed_vertex_key(*parts).alias("number"),
            K.key_text(K.vertex_key(*parts)).alias("rk"),
        )


def number_vertices(graph: StoredGraph, path: str, rows_per_task: int = ROWS_PER_TASK) -> VertexNumbers:
    """Give a number to every vertex of the graph that the dictionary at ``path`` does not have yet.

    Only buckets that loads have written since the last generation are read, of the graph and of the dictionary. Of two calls
    that extend the same generation the second fails. New uids are counted per label, shard and piece of a shard; a prefix sum
    over these counts says where each piece begins, so that no task has to order a whole shard.
    """
    spark, old = graph.spark, VertexNumbers.open(graph.spark, path)
    labels = graph.schema.label_indexes["vertex"]
    shards = graph.schema.shards
    if shards > 1 << K.SHARD_BITS or max(labels.values(), default=0) >= 1 << K.LABEL_BITS:
        raise ValueError(f"a key has room for {1 << K.SHARD_BITS} shards and {1 << K.LABEL_BITS} labels")
    if any(labels.get(label) != i for label, i in old.labels.items()):
        raise ValueError(f"the numbers at {path} are those of other labels")
    current = {label: dict(graph.versions["vertex"].get(label, {})) for label in labels}
    changed = {label: [b for b, v in now.items() if old.covered.get(label, {}).get(b) != v] for label, now in current.items()}
    tables = [
        graph.buckets("vertex", label, buckets).select(F.lit(labels[label]).alias("label_index"), "uid")
        for label, buckets in changed.items()
        if buckets
    ]
    if not tables:
        return old
    bucket = bucket_of(["uid"], shards).cast("int").alias(BUCKET)
    vertices = reduce(DataFrame.unionByName, tables).select("label_index", bucket, "uid")
    touched = [(F.col("label_index") == labels[x]) & F.col(BUCKET).isin([int(b) for b in bs]) for x, bs in changed.items() if bs]
    known = old.entries().where(reduce(lambda a, b: a | b, touched))

    seen, scratch = Observation(), scratch_path(spark, "new-vertices")
    new = vertices.join(known, ["label_index", BUCKET, "uid"], "left_anti")
    new.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(scratch)
    n = seen.get["n"] or 0
    parts = old.parts
    if n:
        shard = ["label_index", BUCKET]
        pieces = -(-n // (shards * rows_per_task))
        new = spark.read.schema(new.schema).parquet(scratch).withColumn("piece", F.pmod(F.xxhash64("uid", F.lit(pieces)), F.lit(pieces)))
        taken = known.groupBy(*shard).agg((F.max("inner") + 1).alias("taken"))
        before = Window.partitionBy(*shard).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        counts = new.groupBy(*shard, "piece").agg(F.count(F.lit(1)).alias("rows"))
        begins = counts.withColumn("begin", F.coalesce(F.sum("rows").over(before), F.lit(0))).join(taken, shard, "left")
        begins = begins.select(*shard, "piece", (F.col("begin") + F.coalesce("taken", F.lit(0))).alias("begin"))
        place = F.row_number().over(Window.partitionBy(*shard, "piece").orderBy("uid"))
        numbered = new.withColumn("place", place).join(begins, [*shard, "piece"])
        part, most = f"{old.generation + 1}-{uuid.uuid4().hex[:8]}", Observation()
        out = numbered.select("uid", (F.col("begin") + F.col("place") - 1).alias("inner"), *shard)
        out.observe(most, F.max("inner").alias("inner")).write.partitionBy(*shard).parquet(f"{old.path}/part={part}")
        if most.get["inner"] >= 1 << K.INNER_ID_BITS:
            raise ValueError(f"a shard of a label has more than {1 << K.INNER_ID_BITS} vertices: use more shards")
        parts = (*parts, part)
    delete_path(spark, scratch)
    note = {"parts": parts, "covered": current, "labels": dict(labels)}
    if not write_once(spark, f"{old.path}/{old.generation + 1}.json", json.dumps(note, ensure_ascii=False)):
        raise ValueError(f"generation {old.generation + 1} of the numbers at {path} already exists: number the vertices again")
    return VertexNumbers(spark, old.path, old.generation + 1, tuple(parts), current, dict(labels))


def uids_to_keys(
    rows: DataFrame, label: str, uid: str, numbers: VertexNumbers, name: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add the row key ``name`` of the vertex that a label and a uid column name; null if it has no number. Hubs are spread."""
    lookup = numbers.table().select(F.col("label").alias(label), F.col("uid").alias(uid), F.col("rk").alias(name))
    return spread_join(rows, lookup, [label, uid], "left", rows_per_task)
