"""Elements as JSON documents. Empty tags and properties are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _non_empty(collection: Column) -> Column:
    return F.when(F.size(collection) > 0, collection)


def vertex_struct(vertex: Column) -> Column:
    """``vertex`` has ``label, uid, rk, tags, properties``."""
    return F.struct(
        F.lit("vertex").alias("type"),
        vertex["label"].alias("label"),
        vertex["uid"].alias("uid"),
        vertex["rk"].alias("RowKeyHexString"),
        _non_empty(vertex["tags"]).alias("tags"),
        _non_empty(vertex["properties"]).alias("properties"),
    )


def _stub_struct(stub: Column) -> Column:
    return F.struct(
        F.lit("vertex").alias("type"),
        stub["label"].alias("label"),
        stub["uid"].alias("uid"),
        stub["rk"].alias("RowKeyHexString"),
    )


def edge_struct(edge: Column) -> Column:
    """``edge`` has ``label, euid, src, dst, rk, tags, properties``."""
    return F.struct(
        F.lit("edge").alias("type"),
        edge["label"].alias("label"),
        edge["euid"].alias("euid"),
        _stub_struct(edge["src"]).alias("startNode"),
        _stub_struct(edge["dst"]).alias("endNode"),
        edge["rk"].alias("RowKeyHexString"),
        _non_empty(edge["tags"]).alias("tags"),
        _non_empty(edge["properties"]).alias("properties"),
    )


def vertex_documents(vertices: DataFrame) -> DataFrame:
    """Vertex elements to JSON texts, one column ``value``."""
    return vertices.select(F.to_json(vertex_struct(_row(vertices))).alias("value"))


def edge_documents(edges: DataFrame) -> DataFrame:
    """Edge elements to JSON texts, one column ``value``."""
    return edges.select(F.to_json(edge_struct(_row(edges))).alias("value"))


def path_documents(paths: DataFrame, column: str = "path") -> Column:
    """A path column as decoded from documents to the array of its elements' JSON texts."""
    return F.transform(
        F.col(column),
        lambda e: F.when(e["kind"] == "vertex", F.to_json(vertex_struct(e["vertex"]))).otherwise(
            F.to_json(edge_struct(e["edge"]))
        ),
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """Write JSON texts as lines."""
    documents.select("value").write.text(path)


def _row(df: DataFrame) -> Column:
    return F.struct(*df.columns)
