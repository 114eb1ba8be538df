"""Element operations, exports and the hand-over of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import Node, Rel, match
from propgraph.functions.properties import PROPERTIES_TYPE, canonical_text, get_property
from propgraph.operators.decode import decode_paths
from propgraph.operators.elements import (
    distinct_elements,
    project_edges,
    project_vertices,
    update_property,
    update_tags,
    where_has,
    with_property,
)
from propgraph.session import scratch_path
from propgraph.sources import export
from propgraph.sources.results import partition_rows, spill, with_parallelism
from suite.decode_queries import VERTEX_LABELS
from suite.decode_queries import path_documents as order_paths
from suite.tables import graph, read


def element_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = project_edges(graph(spark, sf_dir).edges("CONTAINS"))
    return edges.select("label", "euid", "src_label", "src_uid", "dst_label", "dst_uid", F.size("tags").alias("n_tags"), "rk")


def vertex_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_vertices(graph(spark, sf_dir).vertices()).select("label", "uid", "rk")


def vertex_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vertices of the graph, doubled; each comes out once."""
    vertices = graph(spark, sf_dir).vertices().withColumn("kind", F.lit("vertex"))
    return distinct_elements(vertices.unionByName(vertices)).select("label", "uid", "rk")


def _event_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as elements with the free properties of their JSON objects."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("uid"),
        "event_type",
        F.array(F.col("event_type")).alias("tags"),
        F.try_variant_get(F.try_parse_json("props"), "$", PROPERTIES_TYPE).alias("properties"),
    )


def property_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = where_has(_event_elements(spark, sf_dir), "k")
    return with_property(events, "k", "bigint", required=True).where("k > 50").select("uid", "k")


def property_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace one property, add another, replace the tags."""
    events = _event_elements(spark, sf_dir)
    events = update_property(events, "k", get_property(F.col("properties"), "k", "bigint") * 2)
    events = update_property(events, "kind", F.col("event_type"))
    events = update_tags(events, F.array(F.lit("seen"), F.col("event_type")))
    return events.select(
        "uid",
        get_property(F.col("properties"), "k", "bigint").alias("k"),
        get_property(F.col("properties"), "kind").alias("kind"),
        F.size("properties").alias("n_properties"),
        F.array_join("tags", "+").alias("tags"),
    )


def element_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as edges: with row key equal by key, without equal by properties."""
    lines = graph(spark, sf_dir).edges("CONTAINS")
    flag = get_property(F.col("properties"), "l_returnflag")
    key = F.concat_ws(" ", "src.uid", "euid")
    elements = lines.select(F.lit("edge").alias("kind"), F.when(flag != "A", key).alias("rk"), "properties")
    distinct = distinct_elements(elements)
    return distinct.select(
        F.coalesce("rk", F.lit("")).alias("rk"),
        F.when(F.col("rk").isNull(), canonical_text(F.col("properties"))).isNotNull().alias("by_properties"),
        F.when(F.col("rk").isNull(), get_property(F.col("properties"), "l_quantity", "double")).alias("quantity"),
    )


# --- exports --------------------------------------------------------------------------------------------------------


def export_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of all labels written as JSON lines, read again as text."""
    path = scratch_path(spark, "vertices")
    export.write_documents(export.vertex_documents(graph(spark, sf_dir).vertices()), path)
    doc = F.try_parse_json("value")
    return spark.read.text(path).select(
        F.try_variant_get(doc, "$.type", "string").alias("type"),
        F.try_variant_get(doc, "$.label", "string").alias("label"),
        F.try_variant_get(doc, "$.uid", "string").alias("uid"),
        F.col("value").contains('"tags"').alias("has_tags"),
        F.col("value").contains('"properties"').alias("has_properties"),
        F.try_variant_get(doc, "$.properties.c_acctbal", "double").alias("c_acctbal"),
    )


def export_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "edges")
    edges = update_tags(graph(spark, sf_dir).edges("PLACED"), F.array(F.col("src.label"), F.lit("é")))
    export.write_documents(export.edge_documents(edges), path)
    doc = F.try_parse_json("value")
    return spark.read.text(path).select(
        F.try_variant_get(doc, "$.type", "string").alias("type"),
        F.try_variant_get(doc, "$.label", "string").alias("label"),
        F.try_variant_get(doc, "$.euid", "string").alias("euid"),
        F.try_variant_get(doc, "$.startNode.uid", "string").alias("src_uid"),
        F.try_variant_get(doc, "$.endNode.label", "string").alias("dst_label"),
        F.try_variant_get(doc, "$.endNode.uid", "string").alias("dst_uid"),
        F.try_variant_get(doc, "$.tags[1]", "string").alias("tag"),
        F.try_variant_get(doc, "$.properties.o_totalprice", "double").alias("o_totalprice"),
    )


def export_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded paths back to their elements' JSON texts."""
    paths = decode_paths(order_paths(spark, sf_dir), "doc", 18, VERTEX_LABELS)
    texts = paths.select("o_orderkey", F.posexplode(export.path_documents(paths)).alias("pos", "text"))
    doc = F.try_parse_json("text")
    return texts.select(
        "o_orderkey",
        "pos",
        F.try_variant_get(doc, "$.type", "string").alias("type"),
        F.coalesce(
            F.try_variant_get(doc, "$.uid", "string"), F.try_variant_get(doc, "$.startNode.uid", "string")
        ).alias("uid"),
        F.try_variant_get(doc, "$.properties.o_totalprice", "double").alias("o_totalprice"),
    )


# --- results --------------------------------------------------------------------------------------------------------


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(graph(spark, sf_dir), Node("a", "Order"), Rel("f", "CONTAINS"), Node("b", "Part"))
    return rows.select("a_uid", "f_euid", "b_uid", "f_l_quantity")


def result_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parallelism(_matched(spark, sf_dir), 5)


def result_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many partitions as asked for, with all rows."""
    rows = partition_rows(with_parallelism(_matched(spark, sf_dir), 6))
    return rows.agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"))


def result_spill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spill(_matched(spark, sf_dir))


_MATCHED_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS a_uid, CAST(l_linenumber AS VARCHAR) AS f_euid,
                         CAST(l_partkey AS VARCHAR) AS b_uid, l_quantity AS f_l_quantity
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey"""

_VERTEX_SQL = """WITH v AS (
  SELECT 'Region' AS label, CAST(r_regionkey AS VARCHAR) AS uid FROM region
  UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'Customer', CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'Supplier', CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'Part', CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'Order', CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT DISTINCT 'User', CAST(user_id AS VARCHAR) FROM events)
SELECT label, uid, length(label) || ':' || label || ':' || length(uid) || ':' || uid AS rk FROM v"""

QUERIES = {
    "element_project": (
        element_project,
        """SELECT 'CONTAINS' AS label, CAST(l_linenumber AS VARCHAR) AS euid, 'Order' AS src_label,
                  CAST(l_orderkey AS VARCHAR) AS src_uid, 'Part' AS dst_label, CAST(l_partkey AS VARCHAR) AS dst_uid,
                  0 AS n_tags,
                  '8:CONTAINS:5:Order:' || length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || ':4:Part:'
                  || length(CAST(l_partkey AS VARCHAR)) || ':' || l_partkey || ':'
                  || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber AS rk FROM lineitem""",
    ),
    "vertex_project": (vertex_project, _VERTEX_SQL),
    "vertex_distinct": (vertex_distinct, _VERTEX_SQL),
    "property_filter": (
        property_filter,
        """SELECT CAST(event_id AS VARCHAR) AS uid, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
           WHERE json_exists(props, '$.k') AND CAST(json_extract(props, '$.k') AS BIGINT) > 50""",
    ),
    "property_update": (
        property_update,
        """SELECT CAST(event_id AS VARCHAR) AS uid, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS k, event_type AS kind,
                  2 AS n_properties, 'seen+' || event_type AS tags FROM events""",
    ),
    "element_distinct": (
        element_distinct,
        """SELECT DISTINCT CASE WHEN l_returnflag <> 'A' THEN l_orderkey || ' ' || l_linenumber ELSE '' END AS rk,
                  l_returnflag = 'A' AS by_properties, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS quantity FROM lineitem""",
    ),
    "export_vertices": (
        export_vertices,
        """SELECT 'vertex' AS type, label, uid, false AS has_tags, label <> 'User' AS has_properties, c_acctbal FROM (
             SELECT 'Region' AS label, CAST(r_regionkey AS VARCHAR) AS uid, CAST(NULL AS DOUBLE) AS c_acctbal FROM region
             UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR), NULL FROM nation
             UNION ALL SELECT 'Customer', CAST(c_custkey AS VARCHAR), c_acctbal FROM customer
             UNION ALL SELECT 'Supplier', CAST(s_suppkey AS VARCHAR), NULL FROM supplier
             UNION ALL SELECT 'Part', CAST(p_partkey AS VARCHAR), NULL FROM part
             UNION ALL SELECT 'Order', CAST(o_orderkey AS VARCHAR), NULL FROM orders
             UNION ALL SELECT DISTINCT 'User', CAST(user_id AS VARCHAR), NULL FROM events)""",
    ),
    "export_edges": (
        export_edges,
        """SELECT 'edge' AS type, 'PLACED' AS label, '' AS euid, CAST(o_custkey AS VARCHAR) AS src_uid, 'Order' AS dst_label,
                  CAST(o_orderkey AS VARCHAR) AS dst_uid, 'é' AS tag, o_totalprice FROM orders""",
    ),
    "export_paths": (
        export_paths,
        """SELECT o_orderkey, 0 AS pos, 'vertex' AS type, 'c' || o_custkey AS uid, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders
           UNION ALL SELECT o_orderkey, 1, 'edge', 'c' || o_custkey, o_totalprice FROM orders
           UNION ALL SELECT o_orderkey, 2, 'vertex', 'o' || o_orderkey, NULL FROM orders""",
    ),
    "result_repartition": (result_repartition, _MATCHED_SQL),
    "result_partitions": (
        result_partitions,
        """SELECT CAST(6 AS BIGINT) AS partitions, CAST(count(*) AS BIGINT) AS n
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    ),
    "result_spill": (result_spill, _MATCHED_SQL),
}
