"""Graph schemas: labels with typed properties, label indexes, and the JSON schema document.

Two views of the same thing: ``GraphSchema`` describes the one graph a program works on; ``parse_schema_documents`` and
``schema_documents`` convert whole tables of documents (one graph per row) as Spark jobs.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propgraph.functions.rows import compute_once

# Names of the schema document.
VERSION = "__VERSION"
GRAPH_NAME = "graph.name"
INDEX_TYPE = "graph.index.type"
REPLICATION = "graph.replication.number"
SHARDS = "graph.shard.number"
VERTEX_TABLES = "vertex.tables"
EDGE_TABLES = "edge.tables"
ENCRYPTION = "graph.encryption.type"
INDEX_SEPARATED = "graph.index.separated"
LABEL_INDEX = "label.index"
LABEL_VALUE = "label.value"

# Columns every element has, which a declaration must not repeat.
VERTEX_IMPLICIT = ["uid", "ulabel"]
EDGE_IMPLICIT = ["usid", "uslabel", "udid", "udlabel", "uelabel"]
STORED_VERTEX_COLUMNS = ["uid"]
STORED_EDGE_COLUMNS = ["src_label", "src_uid", "dst_label", "dst_uid", "euid"]

# A packed key has 12 bits for the label index, a legacy key 16.
MAX_LABELS = 1 << 16

Properties = Iterable[tuple[str, str]]


def _properties_type(properties: Properties, implicit: list[str], stored: list[str]) -> StructType:
    struct = StructType()
    for name, data_type in properties:
        if name.startswith("__"):
            raise ValueError(f"`{name}`: names that begin with __ are reserved")
        if name.lower() in {c.lower() for c in (*implicit, *stored)}:
            raise ValueError(f"`{name}` is implicit and must not be declared")
        if name.lower() in {c.lower() for c in struct.fieldNames()}:
            raise ValueError(f"property `{name}` is declared twice")
        struct = struct.add(name, StructType.fromDDL(f"x {data_type}")["x"].dataType)
    return struct


@dataclass(frozen=True)
class GraphSchema:
    """Declared schema of a graph. Labels are numbered from 1 in the order of declaration."""

    name: str
    vertex_labels: Mapping[str, StructType]
    edge_labels: Mapping[str, StructType]
    shards: int = 1
    replication: int = 3
    index_type: str = "native"
    version: int = 18
    encryption_type: str | None = None
    index_separated: bool | None = None
    label_indexes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    @staticmethod
    def declare(
        name: str,
        vertex_labels: Mapping[str, Properties],
        edge_labels: Mapping[str, Properties],
        shards: int,
        replication: int = 3,
    ) -> GraphSchema:
        """Declare labels with (name, type) properties, possibly none. The identity columns are implicit."""
        if shards < 1:
            raise ValueError("a graph needs at least one shard")
        vertices = {
            label: _properties_type(p, VERTEX_IMPLICIT, STORED_VERTEX_COLUMNS) for label, p in vertex_labels.items()
        }
        edges = {label: _properties_type(p, EDGE_IMPLICIT, STORED_EDGE_COLUMNS) for label, p in edge_labels.items()}
        return GraphSchema(
            name,
            vertices,
            edges,
            shards,
            replication,
            label_indexes={
                "vertex": {label: i for i, label in enumerate(vertices, 1)},
                "edge": {label: i for i, label in enumerate(edges, 1)},
            },
        )

    def vertex_type(self, label: str) -> StructType:
        return _stored_type(STORED_VERTEX_COLUMNS, self._label(self.vertex_labels, label))

    def edge_type(self, label: str) -> StructType:
        return _stored_type(STORED_EDGE_COLUMNS, self._label(self.edge_labels, label))

    def _label(self, labels: Mapping[str, StructType], label: str) -> StructType:
        if label not in labels:
            raise ValueError(f"label `{label}` is not declared in graph `{self.name}`")
        return labels[label]

    def vertex_label(self, index: int) -> str | None:
        return _label_of(self.label_indexes["vertex"], index)

    def edge_label(self, index: int) -> str | None:
        return _label_of(self.label_indexes["edge"], index)

    def label_table(self, spark: SparkSession) -> DataFrame:
        """``kind, label_index, label_value`` of all labels; at most MAX_LABELS rows per kind."""
        rows = [(kind, i, label) for kind, labels in self.label_indexes.items() for label, i in labels.items()]
        return spark.createDataFrame(rows, "kind string, label_index int, label_value string")

    def document(self) -> str:
        """The schema document; the optional entries only if they are set."""
        doc = {
            VERSION: self.version,
            GRAPH_NAME: self.name,
            INDEX_TYPE: self.index_type,
            REPLICATION: self.replication,
            SHARDS: self.shards,
            VERTEX_TABLES: _label_entries(self.label_indexes["vertex"]),
            EDGE_TABLES: _label_entries(self.label_indexes["edge"]),
        }
        if self.encryption_type:
            doc[ENCRYPTION] = self.encryption_type
        if self.index_separated:
            doc[INDEX_SEPARATED] = self.index_separated
        return json.dumps(doc, ensure_ascii=False)

    # The stored form adds the property types, which the schema document does not carry.

    def to_meta(self) -> dict:
        return {
            "document": json.loads(self.document()),
            "vertex_types": {label: t.jsonValue() for label, t in self.vertex_labels.items()},
            "edge_types": {label: t.jsonValue() for label, t in self.edge_labels.items()},
        }

    @staticmethod
    def from_meta(meta: dict) -> GraphSchema:
        doc = meta["document"]
        return GraphSchema(
            name=doc[GRAPH_NAME],
            vertex_labels={label: StructType.fromJson(t) for label, t in meta["vertex_types"].items()},
            edge_labels={label: StructType.fromJson(t) for label, t in meta["edge_types"].items()},
            shards=doc[SHARDS],
            replication=doc[REPLICATION],
            index_type=doc[INDEX_TYPE],
            version=doc[VERSION],
            encryption_type=doc.get(ENCRYPTION),
            index_separated=doc.get(INDEX_SEPARATED),
            label_indexes={
                "vertex": {e[LABEL_VALUE]: e[LABEL_INDEX] for e in doc[VERTEX_TABLES]},
                "edge": {e[LABEL_VALUE]: e[LABEL_INDEX] for e in doc[EDGE_TABLES]},
            },
        )


def _stored_type(keys: list[str], properties: StructType) -> StructType:
    struct = StructType()
    for name in keys:
        struct = struct.add(name, "string")
    for f in properties.fields:
        struct = struct.add(f)
    return struct


def _label_of(indexes: Mapping[str, int], index: int) -> str | None:
    return next((label for label, i in indexes.items() if i == index), None)


def _label_entries(indexes: Mapping[str, int]) -> list[dict]:
    return [{LABEL_INDEX: i, LABEL_VALUE: label} for label, i in indexes.items()]


# --- label lookup over a table --------------------------------------------------------------------------------------


def label_column(index: Column, labels: Mapping[int, str]) -> Column:
    """Label of an index column from a literal dictionary; unknown gives null. No join, usable inside lambdas."""
    if len(labels) > MAX_LABELS:
        raise ValueError(f"a key can address {MAX_LABELS} labels at most, got {len(labels)}")
    if not labels:
        return F.lit(None).cast("string")
    if min(labels) >= 0 and max(labels) <= 4 * len(labels) + 64:
        # Indexes are nearly consecutive: found by position, where a literal map would be searched entry by entry.
        return F.get(F.array(*(F.lit(labels.get(i)).cast("string") for i in range(max(labels) + 1))), index.cast("int"))
    entries = [F.lit(x) for i, label in labels.items() for x in (i, label)]
    return F.try_element_at(F.create_map(*entries), index.cast("int"))


def resolve_labels(df: DataFrame, index: str, label_dict: DataFrame, kind: str, label: str = "label") -> DataFrame:
    """Add the label of an index column by a join with a ``kind, label_index, label_value`` table; unknown gives null.

    The dictionary has one row per index after the aggregate, and an index has 16 bits at most: the broadcast side cannot
    exceed MAX_LABELS rows, whatever the size of ``df``.
    """
    entries = (
        label_dict.where((F.col("kind") == kind) & F.col("label_index").between(0, MAX_LABELS - 1))
        .groupBy(F.col("label_index").alias("__index"))
        .agg(F.min("label_value").alias(label))
    )
    return df.join(F.broadcast(entries), df[index] == entries["__index"], "left").drop("__index")


def dictionary_problems(label_dict: DataFrame) -> DataFrame:
    """The rows of a ``kind, label_index, label_value`` table that a lookup does not use, with the ``problem``: an index that no
    key can hold, or another label that is taken for the same index (the first in order of text)."""
    best = F.min("label_value").over(Window.partitionBy("kind", "label_index"))
    outside = F.col("label_index").isNull() | ~F.col("label_index").between(0, MAX_LABELS - 1)
    problem = F.when(outside, "index_out_of_range").when(F.col("label_value") != F.col("__best"), "index_taken")
    rows = label_dict.select("kind", "label_index", "label_value", best.alias("__best"))
    return rows.withColumn("problem", problem).where(F.col("problem").isNotNull()).drop("__best")


# --- tables of schema documents -------------------------------------------------------------------------------------


def _doc_value(doc: Column, name: str, data_type: str) -> Column:
    return F.try_variant_get(doc, f"$['{name}']", data_type)


def _doc_labels(doc: Column, name: str) -> Column:
    entries = _doc_value(doc, name, "array<variant>")
    return F.transform(
        entries,
        lambda e: F.struct(
            _doc_value(e, LABEL_INDEX, "int").alias("label_index"),
            _doc_value(e, LABEL_VALUE, "string").alias("label_value"),
        ),
    )


def parse_schema_documents(df: DataFrame, column: str) -> DataFrame:
    """Parse a column of schema documents, one graph per row.

    Adds ``version, name, index_type, replication, shards, vertex_labels, edge_labels, encryption_type, index_separated``
    and ``reason``, which names the first thing that is wrong with the document (null if it is good).
    """
    parsed = df.withColumn("__doc", F.try_parse_json(column))
    doc = F.col("__doc")
    parsed = compute_once(
        parsed,
        df.columns,
        {
            "__keys": F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>")),
            "version": _doc_value(doc, VERSION, "int"),
            "name": _doc_value(doc, GRAPH_NAME, "string"),
            "index_type": _doc_value(doc, INDEX_TYPE, "string"),
            # Numbers may be given as text.
            "replication": _doc_value(doc, REPLICATION, "string").try_cast("int"),
            "shards": _doc_value(doc, SHARDS, "string").try_cast("int"),
            "vertex_labels": _doc_labels(doc, VERTEX_TABLES),
            "edge_labels": _doc_labels(doc, EDGE_TABLES),
            "encryption_type": _doc_value(doc, ENCRYPTION, "string"),
            "index_separated": _doc_value(doc, INDEX_SEPARATED, "boolean"),
        },
    )
    keys = F.col("__keys")
    reason = F.when(F.col(column).isNull(), F.lit(None).cast("string")).when(keys.isNull(), "bad_json")
    for name, why in [
        (VERSION, "no_version"),
        (INDEX_TYPE, "no_index_type"),
        (GRAPH_NAME, "no_name"),
        (REPLICATION, "no_replication_number"),
        (SHARDS, "no_shard_number"),
        (VERTEX_TABLES, "no_vertex_tables"),
        (EDGE_TABLES, "no_edge_tables"),
    ]:
        reason = reason.when(~F.array_contains(keys, name), why)
    reason = reason.when(F.col("replication").isNull(), "bad_replication_number")
    reason = reason.when(F.col("shards").isNull(), "bad_shard_number")
    return parsed.withColumn("reason", reason).drop("__keys")


def schema_documents(df: DataFrame) -> Column:
    """Column that writes a parsed schema (columns as from ``parse_schema_documents``) back as a document."""

    def labels(column: str) -> Column:
        return F.transform(
            F.col(column),
            lambda e: F.struct(e["label_index"].alias(LABEL_INDEX), e["label_value"].alias(LABEL_VALUE)),
        )

    return F.to_json(
        F.struct(
            F.col("version").alias(VERSION),
            F.col("name").alias(GRAPH_NAME),
            F.col("replication").alias(REPLICATION),
            F.col("shards").alias(SHARDS),
            F.col("index_type").alias(INDEX_TYPE),
            labels("vertex_labels").alias(VERTEX_TABLES),
            labels("edge_labels").alias(EDGE_TABLES),
            F.when(F.col("encryption_type") != "", F.col("encryption_type")).alias(ENCRYPTION),
            F.when(F.col("index_separated"), F.lit(True)).alias(INDEX_SEPARATED),
        )
    )


def explode_labels(df: DataFrame) -> DataFrame:
    """Parsed schemas to a label table: ``name, kind, label_index, label_value``."""

    def tagged(kind: str, labels: Column) -> Column:
        entries = F.coalesce(labels, F.array().cast("array<struct<label_index:int,label_value:string>>"))
        return F.transform(entries, lambda e: F.struct(F.lit(kind).alias("kind"), e["label_index"], e["label_value"]))

    entries = F.concat(tagged("vertex", F.col("vertex_labels")), tagged("edge", F.col("edge_labels")))
    return df.select("name", F.explode(entries).alias("l")).select("name", "l.*").toDF(
        "name", "kind", "label_index", "label_value"
    )
