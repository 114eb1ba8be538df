"""Stored graphs: Parquet tables below one root, one folder per label and version.

    <root>/meta/v=<n>.json                       schema and current version of every bucket of every label
    <root>/vertex/<label>/<n>-<id>/__bucket=<b>  one bucket of a vertex table, written for meta version n
    <root>/edge/<label>/<n>-<id>/__bucket=<b>    one bucket of an edge table

A label's rows are dealt to as many buckets as the graph has shards, by a hash of their key. A load writes the buckets that it
touches anew, beside the old ones, and then a new meta version, so it becomes visible in one step; a reader keeps the versions it opened. Two loads that start from the same meta version collide when they write the
next one, and the second fails instead of undoing the first.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.graph import PropertyGraph, table_names
from propgraph.schema import GraphSchema, Properties
from propgraph.session import child_names, delete_path, path_exists, read_text, write_once

KINDS = ("vertex", "edge")
BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], shards: int) -> Column:
    """The name of the bucket that a row with these key columns is in."""
    return F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("string")


class StoredGraph(PropertyGraph):
    """A stored graph at one meta version."""

    def __init__(self, spark: SparkSession, root: str, meta_version: int, meta: dict):
        self.spark = spark
        self.root = root
        self.meta_version = meta_version
        self.schema = GraphSchema.from_meta(meta["schema"])
        self.versions: dict[str, dict[str, dict[str, str]]] = {
            kind: {label: dict(buckets) for label, buckets in meta["versions"][kind].items()} for kind in KINDS
        }
        super().__init__(
            {label: self._table("vertex", label) for label in self.schema.vertex_labels},
            {label: self._table("edge", label) for label in self.schema.edge_labels},
        )

    @staticmethod
    def create(
        spark: SparkSession,
        root: str,
        name: str,
        vertex_labels: Mapping[str, Properties],
        edge_labels: Mapping[str, Properties],
        shards: int,
        replication: int = 3,
    ) -> StoredGraph:
        """Define a graph. Fails if the root already holds one."""
        schema = GraphSchema.declare(name, vertex_labels, edge_labels, shards, replication)
        root = root.rstrip("/")
        if path_exists(spark, f"{root}/meta"):
            raise ValueError(f"there is already a graph at {root}")
        _write_meta(spark, root, 1, {"schema": schema.to_meta(), "versions": {kind: {} for kind in KINDS}})
        return StoredGraph.open(spark, root)

    @staticmethod
    def open(spark: SparkSession, root: str) -> StoredGraph:
        """Open the newest version of a stored graph; an error if there is none."""
        root = root.rstrip("/")
        if not path_exists(spark, f"{root}/meta"):
            raise ValueError(f"no graph at {root}")
        names = (re.fullmatch(r"v=(\d+)\.json", name) for name in child_names(spark, f"{root}/meta"))
        newest = max((int(name[1]) for name in names if name), default=None)
        if newest is None:
            raise ValueError(f"no graph at {root}")
        return StoredGraph(spark, root, newest, json.loads(read_text(spark, _meta_path(root, newest))))

    def drop(self) -> None:
        """Remove the graph with all its data, and the views of its name."""
        self.unregister()
        delete_path(self.spark, self.root)

    def view_names(self) -> dict[str, DataFrame]:
        """The views that SQL has of this version: a table per label, and the labels' numbers."""
        name = re.sub(r"[^A-Za-z0-9_]", "_", self.schema.name)
        views = {f"{name}_label_dict": self.schema.label_table(self.spark)}
        for kind, tables in (("vertex", self.vertex_tables), ("edge", self.edge_tables)):
            views |= {f"{name}_{kind}_{own}": tables[label] for label, own in table_names(list(tables)).items()}
        return views

    def register(self) -> list[str]:
        """Make the tables of this version known to SQL as views of the session, which replace those of another version:
        ``<graph>_vertex_<label>``, ``<graph>_edge_<label>`` and ``<graph>_label_dict``. Their names."""
        views = self.view_names()
        for name, table in views.items():
            table.createOrReplaceTempView(f"`{name}`")
        return list(views)

    def unregister(self) -> None:
        """Remove the views, if there are any."""
        for name in self.view_names():
            self.spark.catalog.dropTempView(name)

    def describe(self) -> str:
        """The schema document."""
        return self.schema.document()

    def new_table_version(self) -> str:
        return f"{self.meta_version + 1}-{uuid.uuid4().hex[:8]}"

    def table_path(self, kind: str, label: str, version: str) -> str:
        return f"{self.root}/{kind}/{label}/{version}"

    def _table(self, kind: str, label: str) -> DataFrame:
        return self.buckets(kind, label, self.versions[kind].get(label, {}))

    def buckets(self, kind: str, label: str, buckets: Iterable[str]) -> DataFrame:
        """The rows of some buckets of a label; of a bucket without data there are none."""
        schema = self.schema.vertex_type(label) if kind == "vertex" else self.schema.edge_type(label)
        current = self.versions[kind].get(label, {})
        paths = [f"{self.table_path(kind, label, current[b])}/{BUCKET}={b}" for b in sorted(buckets) if b in current]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vertex_rows(self, label: str, uids: Sequence[str] | None) -> DataFrame:
        """The buckets of a label that vertices with these uids are in; all of them without uids."""
        if uids is None or not self.has_data("vertex", label):
            return super().vertex_rows(label, uids)
        ids = self.spark.createDataFrame([(str(u),) for u in uids], "uid string")
        return self.buckets("vertex", label, {row[0] for row in ids.select(bucket_of(["uid"], self.schema.shards)).collect()})

    def has_data(self, kind: str, label: str) -> bool:
        return bool(self.versions[kind].get(label))

    def publish(self, kind: str, label: str, version: str, buckets: Iterable[str]) -> StoredGraph:
        """Make written buckets the current ones and return the graph that has them."""
        versions = {k: {name: dict(b) for name, b in v.items()} for k, v in self.versions.items()}
        versions[kind].setdefault(label, {}).update(dict.fromkeys(buckets, version))
        meta = {"schema": self.schema.to_meta(), "versions": versions}
        _write_meta(self.spark, self.root, self.meta_version + 1, meta)
        return StoredGraph(self.spark, self.root, self.meta_version + 1, meta)

    def delete_old_versions(self) -> int:
        """Delete the buckets that this version of the graph does not use; the number deleted.

        For the newest version, while no load runs and nobody reads an older one.
        """
        deleted = 0
        for kind, labels in (("vertex", self.schema.vertex_labels), ("edge", self.schema.edge_labels)):
            for label in labels:
                current = self.versions[kind].get(label, {})
                for version in child_names(self.spark, f"{self.root}/{kind}/{label}"):
                    path, used = self.table_path(kind, label, version), version in current.values()
                    for name in child_names(self.spark, path):
                        if name.startswith(f"{BUCKET}=") and current.get(name.removeprefix(f"{BUCKET}=")) != version:
                            deleted += delete_path(self.spark, f"{path}/{name}")
                    if not used:
                        delete_path(self.spark, path)
        return deleted

    def fingerprint(self) -> str:
        """Text that changes whenever the graph's data may have changed. Table versions are part of it: they are unique, so a
        graph that is dropped and made anew at the same place has another text."""
        return f"{self.root}@{json.dumps(self.versions, sort_keys=True)}"


def _meta_path(root: str, version: int) -> str:
    return f"{root}/meta/v={version}.json"


def _write_meta(spark: SparkSession, root: str, version: int, meta: dict) -> None:
    if not write_once(spark, _meta_path(root, version), json.dumps(meta, ensure_ascii=False)):
        raise ValueError(f"version {version} of the graph at {root} already exists: another load has published it; open it and load again")
