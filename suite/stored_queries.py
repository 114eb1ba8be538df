"""The main sequence on a stored graph: delimited text, external table, graph, loads, match, PageRank."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import Node, PropertyGraph, Rel, match
from propgraph.functions import keys as K
from propgraph.operators.elements import keys_to_uids
from propgraph.operators.load import load_edges, load_vertices
from propgraph.plans.adjacency import BucketedGraph, bucket_graph
from propgraph.plans.numbers import number_vertices, uids_to_keys
from propgraph.plans.pagerank import pagerank
from propgraph.plans.views import GraphView, graph_view, materialize
from propgraph.session import scratch_path
from propgraph.sources.tables import create_table, sql
from propgraph.storage import StoredGraph
from suite.algorithm_queries import rank_sql, rounded
from suite.tables import graph, read

UIDS = ["1", "5", "7", "no such id"]


def _text_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table written as delimited text and taken up again as an external table."""
    path = scratch_path(spark, "text")
    df.write.option("sep", ",").csv(path)
    return create_table(spark, path, f"external_{uuid.uuid4().hex}", [tuple(c) for c in df.dtypes], "textfile", ",")


def supply_graph(spark: SparkSession, sf_dir: str) -> StoredGraph:
    """Suppliers, parts and who supplies what, from text through the loads."""
    g = StoredGraph.create(
        spark,
        scratch_path(spark, "graph"),
        "supply",
        {"Supplier": [("balance", "double")], "Part": [("size", "int")]},
        {"SUPPLIES": []},
        shards=4,
    )
    suppliers = _text_table(spark, read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"))
    parts = _text_table(spark, read(spark, sf_dir, "part").select("p_partkey", "p_size"))
    lines = _text_table(spark, read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey"))
    g = load_vertices(g, suppliers, "Supplier", [("__uid", "s_suppkey"), ("balance", "s_acctbal")]).graph
    g = load_vertices(g, parts, "Part", [("__uid", "p_partkey"), ("size", "p_size")]).graph
    mapping = [("__usid", "l_suppkey"), ("__udid", "l_partkey"), ("__uslabels", "['Supplier']"), ("__udlabels", "['Part']")]
    return load_edges(g, lines, "SUPPLIES", mapping).graph


def stored_match_uid_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uid predicates on a stored graph reach the Parquet filter."""
    rows = match(supply_graph(spark, sf_dir), Node("a", "Supplier", uids=UIDS), Rel("f", "SUPPLIES"), Node("b", "Part"))
    return rows.select("a_uid", "a_balance", "b_uid", "b_size")


#: So few edges to a task that parts and suppliers with many of them are hubs at every scale of the test tables.
HUB_EDGES = 20


def bucketed_supply(spark: SparkSession, sf_dir: str) -> BucketedGraph:
    """The test tables' suppliers, parts and line items as a graph in bucketed tables."""
    g = graph(spark, sf_dir)
    labels = PropertyGraph({n: g.vertex_tables[n] for n in ("Supplier", "Part")}, {"SUPPLIED_BY": g.edge_tables["SUPPLIED_BY"]})
    name = f"supply_{uuid.uuid4().hex}"
    return bucket_graph(spark, labels, name, 8, scratch_path(spark, name), rows_per_task=HUB_EDGES)


def bucketed_match_one_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges are joined where they lie, at both ends of the pattern in turn; hubs beside them."""
    g = bucketed_supply(spark, sf_dir)
    out = match(g, Node("a", "Part"), Rel("f", "SUPPLIED_BY"), Node("b", "Supplier", properties=False))
    back = match(g, Node("a", "Part", properties=False), Rel("f", "SUPPLIED_BY"), Node("b", "Supplier", uids=UIDS))
    columns = ["a_uid", "f_euid", "b_uid"]
    named = [out.select(F.lit("out").alias("way"), *columns, F.col("a_p_name").alias("name"))]
    named.append(back.select(F.lit("back").alias("way"), *columns, F.col("b_s_name").alias("name")))
    return named[0].unionByName(named[1])


def stored_vertex_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers numbered after each of two loads: no number twice, none left out, the first ones as they were."""
    labels = {"Supplier": [("balance", "double")], "Part": [("size", "int")]}
    g = StoredGraph.create(spark, scratch_path(spark, "graph"), "supply", labels, {"SUPPLIES": []}, shards=4)
    path, mapping = scratch_path(spark, "numbers"), [("__uid", "p_partkey"), ("size", "p_size")]
    parts = read(spark, sf_dir, "part")
    g = load_vertices(g, parts.where("p_partkey % 3 = 0"), "Part", mapping).graph
    first = number_vertices(g, path, rows_per_task=100).table().select("label", "uid", F.col("number").alias("first"))
    g = load_vertices(g, parts, "Part", mapping).graph
    g = load_vertices(g, read(spark, sf_dir, "supplier"), "Supplier", [("__uid", "s_suppkey"), ("balance", "s_acctbal")]).graph
    table = number_vertices(g, path, rows_per_task=100).table()
    of_shard = table.join(first, ["label", "uid"], "left").groupBy("label", "label_index", "shard").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("number").alias("keys"),
        (F.max("inner") + 1).alias("room"),
        F.count_if(F.col("first") == F.col("number")).alias("kept"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "keys", "room", "kept")]
    return of_shard.groupBy("label", "label_index").agg(F.count(F.lit(1)).alias("shards"), *sums)


def stored_keys_to_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges as pairs of packed keys, and the keys turned back into ids and label numbers."""
    g = supply_graph(spark, sf_dir)
    numbers = number_vertices(g, scratch_path(spark, "numbers"))
    rows = g.edge_tables["SUPPLIES"].select("src_label", "src_uid", "dst_label", "dst_uid")
    for side in ("src", "dst"):
        rows = uids_to_keys(rows, f"{side}_label", f"{side}_uid", numbers, f"{side}_rk", rows_per_task=HUB_EDGES)
    rows = rows.select("src_rk", "dst_rk")
    for side in ("src", "dst"):
        rows = keys_to_uids(rows, f"{side}_rk", numbers.table(), f"{side}_uid", rows_per_task=HUB_EDGES)
    index = [K.label_index(F.split(f"{side}_rk", " ").cast("array<int>")).alias(f"{side}_index") for side in ("src", "dst")]
    return rows.select("src_uid", "dst_uid", *index)


def sql_on_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the views of a loaded graph, with the numbers of its labels."""
    supply_graph(spark, sf_dir).register()
    return sql(
        spark,
        """SELECT s.uid AS supplier, d.label_index AS part_index, count(*) AS n, sum(p.size) AS total
           FROM supply_edge_SUPPLIES e JOIN supply_vertex_Supplier s ON s.uid = e.src_uid JOIN supply_vertex_Part p ON p.uid = e.dst_uid
           JOIN supply_label_dict d ON d.kind = 'vertex' AND d.label_value = e.dst_label
           WHERE s.balance > 0 GROUP BY ALL""",
    )


def stored_view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of large deliveries, before and after a load that sets the quantities of one order to zero; of the edges only the
    buckets that it has written are counted again."""
    labels = {"Supplier": [], "Part": []}
    g = StoredGraph.create(spark, scratch_path(spark, "graph"), "deliveries", labels, {"DELIVERS": [("quantity", "double")]}, shards=16)
    g = load_vertices(g, read(spark, sf_dir, "supplier"), "Supplier", [("__uid", "s_suppkey")]).graph
    g = load_vertices(g, read(spark, sf_dir, "part"), "Part", [("__uid", "p_partkey")]).graph
    lines = read(spark, sf_dir, "lineitem").selectExpr("*", "concat(l_orderkey, '-', l_linenumber) AS line", "0D AS none")
    mapping = [("__usid", "l_suppkey"), ("__udid", "l_partkey"), ("__uslabels", "['Supplier']"), ("__udlabels", "['Part']")]
    mapping.append(("__uid", "line"))
    g = load_edges(g, lines, "DELIVERS", [*mapping, ("quantity", "l_quantity")]).graph
    path = scratch_path(spark, "refreshed-view")

    def large(graph: StoredGraph) -> GraphView:
        return graph_view(graph, edge_patterns=[Rel("f", "DELIVERS", where="quantity > 10")])

    materialize(spark, large(g), path, rows_per_task=HUB_EDGES)
    first_order = lines.agg(F.min("l_orderkey").alias("l_orderkey"))
    g = load_edges(g, lines.join(first_order, "l_orderkey"), "DELIVERS", [*mapping, ("quantity", "none")]).graph
    again = materialize(spark, large(g), path, rows_per_task=HUB_EDGES)
    src = again.vertices.select(F.col("id").alias("src"), F.col("uid").alias("supplier"))
    dst = again.vertices.select(F.col("id").alias("dst"), F.col("uid").alias("part"))
    return again.edges.join(src, "src").join(dst, "dst").select("supplier", "part", "w")


def stored_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(spark, graph_view(supply_graph(spark, sf_dir)), rounds=5))


QUERIES = {
    "bucketed_match_one_hop": (
        bucketed_match_one_hop,
        """WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS a_uid, l_orderkey || '-' || l_linenumber AS f_euid,
                             CAST(s_suppkey AS VARCHAR) AS b_uid, p_name, s_name
                      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)
           SELECT 'out' AS way, a_uid, f_euid, b_uid, p_name AS name FROM m
           UNION ALL SELECT 'back', a_uid, f_euid, b_uid, s_name FROM m WHERE b_uid IN ('1', '5', '7', 'no such id')""",
    ),
    "stored_match_uid_in": (
        stored_match_uid_in,
        """SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS a_uid, s_acctbal AS a_balance, CAST(p_partkey AS VARCHAR) AS b_uid,
                  CAST(p_size AS INTEGER) AS b_size
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
           WHERE CAST(s_suppkey AS VARCHAR) IN ('1', '5', '7', 'no such id')""",
    ),
    "stored_vertex_numbers": (
        stored_vertex_numbers,
        """SELECT 'Part' AS label, 2 AS label_index, 4 AS shards, count(*) AS n, count(*) AS keys, count(*) AS room,
                  count(*) FILTER (WHERE p_partkey % 3 = 0) AS kept FROM part
           UNION ALL SELECT 'Supplier', 1, least(4, count(*)), count(*), count(*), count(*), 0 FROM supplier""",
    ),
    "stored_keys_to_uids": (
        stored_keys_to_uids,
        """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS src_uid, CAST(l_partkey AS VARCHAR) AS dst_uid, CAST(1 AS BIGINT) AS src_index,
                  CAST(2 AS BIGINT) AS dst_index FROM lineitem""",
    ),
    "sql_on_graph": (
        sql_on_graph,
        """SELECT CAST(s_suppkey AS VARCHAR) AS supplier, 2 AS part_index, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total
           FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
           WHERE s_acctbal > 0 GROUP BY s_suppkey""",
    ),
    "stored_view_refresh": (
        stored_view_refresh,
        """SELECT CAST(l_suppkey AS VARCHAR) AS supplier, CAST(l_partkey AS VARCHAR) AS part, count(*) AS w
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
           WHERE l_quantity > 10 AND l_orderkey <> (SELECT min(l_orderkey) FROM lineitem) GROUP BY ALL""",
    ),
    "stored_pagerank": (
        stored_pagerank,
        rank_sql(
            "SELECT label || ':' || uid AS id FROM v WHERE label IN ('Part', 'Supplier')",
            "SELECT src_label || ':' || src_uid AS src, dst_label || ':' || dst_uid AS dst FROM e WHERE label = 'SUPPLIES'",
            "SELECT id FROM vs",
            5,
        ),
    ),
}
