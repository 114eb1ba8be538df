"""Discover a graph's schema from its data: which properties occur per label, and which label pairs an edge label joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.graph import PropertyGraph


def profile_vertices(graph: PropertyGraph) -> DataFrame:
    """``label, field, n``: the elements that have the field. One pass per label; a label without properties has no row."""
    parts = []
    for label, table in graph.vertex_tables.items():
        fields = graph.vertex_properties(label)
        if fields:
            parts.append(_unpivot(table.agg(*(F.count(f"`{c}`").alias(c) for c in fields)), label, fields))
    return _present(graph, parts)


def profile_edges(graph: PropertyGraph) -> DataFrame:
    """As ``profile_vertices``, for edge labels."""
    parts = []
    for label, table in graph.edge_tables.items():
        fields = graph.edge_properties(label)
        if fields:
            parts.append(_unpivot(table.agg(*(F.count(f"`{c}`").alias(c) for c in fields)), label, fields))
    return _present(graph, parts)


def profile_endpoints(graph: PropertyGraph) -> DataFrame:
    """``label, src_label, dst_label, n`` of all edge labels."""
    return graph.edge_ids().groupBy("label", "src_label", "dst_label").agg(F.count(F.lit(1)).alias("n"))


def profile_elements(elements: DataFrame) -> DataFrame:
    """``label, field, n`` of elements with free properties (``label, properties``)."""
    return (
        elements.select("label", F.explode(F.map_keys("properties")).alias("field"))
        .groupBy("label", "field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def schema_from_data(graph: PropertyGraph) -> DataFrame:
    """The discovered schema as one JSON document, column ``value``. Its size is that of the schema, not of the data."""
    spark = next(iter(graph.vertex_tables.values())).sparkSession
    vertex_labels = spark.createDataFrame([(label,) for label in graph.vertex_tables], "label string")
    edge_labels = spark.createDataFrame([(label,) for label in graph.edge_tables], "label string")
    fields = F.sort_array(F.collect_set("field")).alias("fields")
    vertices = vertex_labels.join(profile_vertices(graph), "label", "left").groupBy("label").agg(fields)
    pairs = (
        profile_endpoints(graph)
        .groupBy("label")
        .agg(
            F.sort_array(
                F.collect_set(F.struct(F.col("src_label").alias("src"), F.col("dst_label").alias("dst")))
            ).alias("src_dst_labels")
        )
    )
    edges = edge_labels.join(profile_edges(graph), "label", "left").groupBy("label").agg(fields).join(pairs, "label", "left")
    parts = vertices.select(F.lit("v").alias("kind"), F.struct("label", "fields").alias("v"), F.lit(None).alias("e"))
    edge_part = edges.select(
        F.lit("e").alias("kind"), F.lit(None).alias("v"), F.struct("label", "fields", "src_dst_labels").alias("e")
    )
    return (
        parts.unionByName(edge_part)
        .groupBy()
        .agg(
            F.to_json(
                F.struct(
                    F.sort_array(F.collect_list("v")).alias("vertices"), F.sort_array(F.collect_list("e")).alias("edges")
                )
            ).alias("value")
        )
    )


def _unpivot(counts: DataFrame, label: str, fields: list[str]) -> DataFrame:
    long = counts.unpivot([], fields, "field", "n")
    return long.select(F.lit(label).alias("label"), "field", "n")


def _present(graph: PropertyGraph, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        spark = next(iter(graph.vertex_tables.values())).sparkSession
        return spark.createDataFrame([], "label string, field string, n bigint")
    return reduce(DataFrame.unionByName, parts).where("n > 0")
