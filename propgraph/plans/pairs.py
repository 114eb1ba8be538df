"""Numbers of parallel edges, kept bucket by bucket: a view of a stored graph counts only the buckets that loads have written.

    <path>/<n>.json                                    generation n: label -> bucket -> version of the table it was counted in, part
    <path>/part=<n>-<id>/label_index=<i>/__bucket=<b>  the edges of a bucket that are in the view, counted by their endpoints

A bucket's version names its files for good, so counts of a version that is still current are the counts of today.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.graph import EDGE_KEY_COLUMNS, ENDPOINT_COLUMNS
from propgraph.session import child_names, delete_path, read_text, write_once
from propgraph.storage import BUCKET, StoredGraph, bucket_of

COUNTS = f"src_label string, src_uid string, dst_label string, dst_uid string, w bigint, label_index int, {BUCKET} int"


@dataclass(frozen=True)
class EdgeBuckets:
    """The edges of a view of a stored graph. ``select`` keeps those of a label's table that are in the view; equal ``name``
    means equal graph folder and equal conditions, whatever the graph's version."""

    graph: StoredGraph
    select: Mapping[str, Callable[[DataFrame], DataFrame]]
    name: str

    def versions(self) -> dict[str, dict[str, str]]:
        return {label: dict(self.graph.versions["edge"].get(label, {})) for label in self.select}

    def rows(self, label: str, buckets: Sequence[str]) -> DataFrame:
        return self.select[label](self.graph.buckets("edge", label, buckets))


def kept_pairs(spark: SparkSession, path: str, edges: EdgeBuckets) -> DataFrame:
    """``src_label, src_uid, dst_label, dst_uid`` and the number ``w`` of edges between them in one bucket, a row for each bucket
    that has some; from the counts below ``path`` where these are of today's versions.

    The other buckets are read, counted and kept for the next time. If another build has kept the same generation meanwhile,
    that one stays and these counts serve this build alone.
    """
    generation, known = _newest(spark, path)
    current, indexes = edges.versions(), edges.graph.schema.label_indexes["edge"]
    changed = {label: [b for b, v in now.items() if known.get(label, {}).get(b, [None])[0] != v] for label, now in current.items()}
    tables = [
        edges.rows(label, buckets).select(F.lit(indexes[label]).alias("label_index"), *EDGE_KEY_COLUMNS)
        for label, buckets in changed.items()
        if buckets
    ]
    part = f"{generation + 1}-{uuid.uuid4().hex[:8]}"
    if tables:
        bucket = bucket_of(EDGE_KEY_COLUMNS, edges.graph.schema.shards).cast("int").alias(BUCKET)
        rows = reduce(DataFrame.unionByName, tables).select("label_index", bucket, *ENDPOINT_COLUMNS)
        counts = rows.groupBy("label_index", BUCKET, *ENDPOINT_COLUMNS).agg(F.count(F.lit(1)).alias("w"))
        # Adaptive execution sizes the files of each bucket, and cuts large ones.
        counts.hint("rebalance", "label_index", BUCKET).write.partitionBy("label_index", BUCKET).parquet(f"{path}/part={part}")
    kept = {
        label: {b: [v, part] if b in changed[label] else known[label][b] for b, v in now.items()} for label, now in current.items()
    }
    if tables:
        write_once(spark, f"{path}/{generation + 1}.json", json.dumps(kept, ensure_ascii=False))
    return _read(spark, path, kept, indexes).select(*ENDPOINT_COLUMNS, "w")


def _newest(spark: SparkSession, path: str) -> tuple[int, dict]:
    names = (re.fullmatch(r"(\d+)\.json", name) for name in child_names(spark, path))
    newest = max((int(name[1]) for name in names if name), default=0)
    return newest, json.loads(read_text(spark, f"{path}/{newest}.json")) if newest else {}


def _read(spark: SparkSession, path: str, kept: Mapping[str, Mapping[str, Sequence[str]]], indexes: Mapping[str, int]) -> DataFrame:
    """The counts of the buckets named. Part, label and bucket are folders, so what others a part holds is not read."""
    places: dict[tuple[str, str], list[int]] = {}
    for label, buckets in kept.items():
        for bucket, (_, part) in buckets.items():
            places.setdefault((part, label), []).append(int(bucket))
    if not places:
        return spark.createDataFrame([], COUNTS)
    folders = [f"{path}/part={part}" for part in sorted({part for part, _ in places})]
    stored = spark.read.schema(f"{COUNTS}, part string").option("basePath", path).parquet(*folders)
    wanted = [(F.col("part") == p) & (F.col("label_index") == indexes[x]) & F.col(BUCKET).isin(bs) for (p, x), bs in places.items()]
    return stored.where(reduce(Column.__or__, wanted))


def delete_old_pairs(spark: SparkSession, path: str) -> int:
    """Delete the parts that the newest generation does not use; the number deleted. While no view is being built from them."""
    used = {part for buckets in _newest(spark, path)[1].values() for _, part in buckets.values()}
    parts = [name for name in child_names(spark, path) if name.startswith("part=") and name.removeprefix("part=") not in used]
    return sum(delete_path(spark, f"{path}/{name}") for name in parts)
