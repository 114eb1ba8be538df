"""Pattern match, projections and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import Node, Rel, match
from propgraph.functions.properties import has_property
from propgraph.operators.elements import distinct_paths, path_length
from propgraph.operators.match import (
    bind_path,
    collect_ids,
    count_matches,
    distinct_matches,
    match_vertices,
    top_k,
)
from propgraph.sources.export import path_documents
from suite.tables import GRAPH_SQL, graph

# So few rows to a task that suppliers are hubs at every scale of the test tables.
HUB_ROWS = 400

UIDS = ["0", "1", "2", "17", "42", "99", "no such id"]


def match_one_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(graph(spark, sf_dir), Node("a", "Customer"), Rel("f", "PLACED"), Node("b", "Order"))
    return rows.select("a_uid", "a_c_name", "f_label", "f_day", "b_uid", "b_o_totalprice")


def match_any_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(graph(spark, sf_dir), Node("a", properties=False), Rel("f"), Node("b", properties=False))
    return rows.select("a_label", "a_uid", "f_label", "f_euid", "b_label", "b_uid")


def match_one_hop_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(graph(spark, sf_dir), Node("a", "Customer"), Rel("f", "PLACED"), Node("b", "Order"))
    rows = top_k(rows, [F.desc("b_o_totalprice"), F.asc("b_uid")], 5)
    return rows.select(F.col("a_uid").alias("customer"), F.col("b_uid").alias("order_id"), "b_o_totalprice")


def match_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are hubs: every line item ends at one of few."""
    rows = match(
        graph(spark, sf_dir), Node("a", "Part"), Rel("f", "SUPPLIED_BY"), Node("b", "Supplier"), spread_hubs=True,
        rows_per_task=HUB_ROWS,
    )
    return rows.select("a_uid", "a_p_brand", "f_euid", "f_l_extendedprice", "b_uid", "b_s_name")


def match_uid_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_vertices(graph(spark, sf_dir), Node("a", uids=UIDS)).select("label", "uid")


def match_one_hop_uid_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(graph(spark, sf_dir), Node("a", "Customer", uids=UIDS), Rel("f", "PLACED"), Node("b", "Order"))
    return rows.select("a_uid", "b_uid", "f_o_totalprice")


def match_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(
        graph(spark, sf_dir),
        Node("a", "Customer", where="c_mktsegment = 'BUILDING'"),
        Rel("f", "PLACED", where="o_totalprice > 100000"),
        Node("b", "Order", where="o_orderstatus = 'O'"),
    )
    return rows.select("a_uid", "b_uid", "f_o_totalprice")


def collect_vertex_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match_vertices(graph(spark, sf_dir), Node("a", "Customer"))
    return collect_ids(found, lists=16).select("chunk", "n", F.array_join("ids", ",").alias("ids"))


def query_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids := customers of one region; then their orders."""
    g = graph(spark, sf_dir)
    in_region = match(
        g,
        Node("a", "Customer"),
        Rel("f", "IN_NATION"),
        Node("n", "Nation"),
        Rel("h", "IN_REGION"),
        Node("r", "Region", where="r_name = 'ASIA'"),
    )
    ids = in_region.select(F.col("a_uid").alias("uid"))
    rows = match(g, Node("a", "Customer", uids=ids), Rel("f", "PLACED"), Node("b", "Order"))
    return rows.select("a_uid", "b_uid")


TWO_HOPS = (Node("a", "Customer"), Rel("f", "PLACED"), Node("o", "Order"), Rel("h", "CONTAINS"), Node("p", "Part"))


def match_two_hop_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind_path(match(graph(spark, sf_dir), *TWO_HOPS), TWO_HOPS, properties=False)
    text = F.array_join(
        F.transform("path", lambda e: F.when(e["kind"] == "vertex", F.concat(e["vertex"]["label"], F.lit(":"), e["vertex"]["uid"])).otherwise(e["edge"]["label"])),
        "/",
    )
    return rows.select("a_uid", "h_euid", path_length(F.col("path")).alias("length"), text.alias("path"))


def path_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items may repeat an edge; as paths they are the same."""
    pattern = (Node("o", "Order", properties=False), Rel("h", "CONTAINS"), Node("p", "Part", properties=False))
    return distinct_matches(match(graph(spark, sf_dir), *pattern), pattern).select("o_uid", "h_euid", "p_uid")


def matched_paths_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match twice, as paths with whole elements, then each path once. Line items may repeat an edge's identity."""
    pattern = (Node("o", "Order"), Rel("h", "CONTAINS"), Node("p", "Part"))
    paths = bind_path(match(graph(spark, sf_dir), *pattern), pattern).select("path")
    columns = [
        F.col("path")[0]["vertex"]["uid"].alias("o_uid"),
        F.col("path")[1]["edge"]["euid"].alias("h_euid"),
        has_property(F.col("path")[1]["edge"]["properties"], "l_quantity").alias("has_quantity"),
        F.col("path")[2]["vertex"]["uid"].alias("p_uid"),
        path_length(F.col("path")).alias("length"),
    ]
    return distinct_paths(paths.unionByName(paths), select=columns)


def matched_paths_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match, bound as paths and exported as JSON documents, with a property of the edge and row keys."""
    pattern = (Node("a", "Customer"), Rel("f", "PLACED"), Node("b", "Order"))
    paths = bind_path(match(graph(spark, sf_dir), *pattern), pattern).select("path")
    texts = paths.select(F.posexplode(path_documents(paths)).alias("pos", "text"))
    fields = {"type": "type", "uid": "uid", "rk": "RowKeyHexString", "end_uid": "endNode.uid"}
    return texts.select(
        "pos",
        *(F.get_json_object("text", f"$.{path}").alias(name) for name, path in fields.items()),
        F.get_json_object("text", "$.properties.o_totalprice").cast("double").alias("o_totalprice"),
    )


def two_hop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways from each supplier over a part it supplies to any supplier; parts have many edges on both sides."""
    counts = count_matches(
        graph(spark, sf_dir),
        Node("a", "Supplier"),
        Rel("f", "SUPPLIES"),
        Node("p", "Part"),
        Rel("h", "SUPPLIED_BY"),
        Node("b", "Supplier"),
    )
    return counts.select("uid", "n")


_IN_LIST = ", ".join(f"'{u}'" for u in UIDS)

QUERIES = {
    "match_one_hop": (
        match_one_hop,
        """SELECT CAST(c_custkey AS VARCHAR) AS a_uid, c_name AS a_c_name, 'PLACED' AS f_label,
                  strftime(o_orderdate, '%Y-%m-%d') AS f_day, CAST(o_orderkey AS VARCHAR) AS b_uid,
                  o_totalprice AS b_o_totalprice
           FROM customer JOIN orders ON o_custkey = c_custkey""",
    ),
    "match_any_label": (
        match_any_label,
        f"""WITH {GRAPH_SQL}
            SELECT a.label AS a_label, a.uid AS a_uid, e.label AS f_label, e.euid AS f_euid, b.label AS b_label, b.uid AS b_uid
            FROM e JOIN v a ON a.label = e.src_label AND a.uid = e.src_uid
                   JOIN v b ON b.label = e.dst_label AND b.uid = e.dst_uid""",
    ),
    "match_one_hop_topk": (
        match_one_hop_topk,
        """SELECT CAST(c_custkey AS VARCHAR) AS customer, CAST(o_orderkey AS VARCHAR) AS order_id,
                  o_totalprice AS b_o_totalprice
           FROM customer JOIN orders ON o_custkey = c_custkey ORDER BY o_totalprice DESC, order_id LIMIT 5""",
    ),
    "match_hubs": (
        match_hubs,
        """SELECT CAST(p_partkey AS VARCHAR) AS a_uid, p_brand AS a_p_brand, l_orderkey || '-' || l_linenumber AS f_euid,
                  l_extendedprice AS f_l_extendedprice, CAST(s_suppkey AS VARCHAR) AS b_uid, s_name AS b_s_name
           FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    ),
    "match_uid_in": (match_uid_in, f"WITH {GRAPH_SQL} SELECT label, uid FROM v WHERE uid IN ({_IN_LIST})"),
    "match_one_hop_uid_in": (
        match_one_hop_uid_in,
        f"""SELECT CAST(c_custkey AS VARCHAR) AS a_uid, CAST(o_orderkey AS VARCHAR) AS b_uid, o_totalprice AS f_o_totalprice
            FROM customer JOIN orders ON o_custkey = c_custkey WHERE CAST(c_custkey AS VARCHAR) IN ({_IN_LIST})""",
    ),
    "match_property": (
        match_property,
        """SELECT CAST(c_custkey AS VARCHAR) AS a_uid, CAST(o_orderkey AS VARCHAR) AS b_uid, o_totalprice AS f_o_totalprice
           FROM customer JOIN orders ON o_custkey = c_custkey
           WHERE c_mktsegment = 'BUILDING' AND o_totalprice > 100000 AND o_orderstatus = 'O'""",
    ),
    "collect_ids": (
        collect_vertex_ids,
        """WITH k AS (SELECT CAST(c_custkey AS VARCHAR) AS uid FROM customer)
           SELECT CAST(('0x' || substr(md5(uid), 1, 8)) AS BIGINT) % 16 AS chunk, count(*) AS n,
                  string_agg(uid, ',' ORDER BY uid) AS ids
           FROM k GROUP BY 1""",
    ),
    "query_variable": (
        query_variable,
        """SELECT CAST(c_custkey AS VARCHAR) AS a_uid, CAST(o_orderkey AS VARCHAR) AS b_uid
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
           JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'""",
    ),
    "match_two_hop_path": (
        match_two_hop_path,
        """SELECT CAST(c_custkey AS VARCHAR) AS a_uid, CAST(l_linenumber AS VARCHAR) AS h_euid, 5 AS length,
                  'Customer:' || c_custkey || '/PLACED/Order:' || o_orderkey || '/CONTAINS/Part:' || p_partkey AS path
           FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
           JOIN part ON p_partkey = l_partkey""",
    ),
    "path_distinct": (
        path_distinct,
        """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS o_uid, CAST(l_linenumber AS VARCHAR) AS h_euid,
                  CAST(p_partkey AS VARCHAR) AS p_uid
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""",
    ),
    "matched_paths_distinct": (
        matched_paths_distinct,
        """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS o_uid, CAST(l_linenumber AS VARCHAR) AS h_euid,
                  true AS has_quantity, CAST(p_partkey AS VARCHAR) AS p_uid, 3 AS length
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""",
    ),
    "matched_paths_export": (
        matched_paths_export,
        """WITH m AS (SELECT CAST(c_custkey AS VARCHAR) AS c, CAST(o_orderkey AS VARCHAR) AS o, o_totalprice
                      FROM orders JOIN customer ON c_custkey = o_custkey)
           SELECT 0 AS pos, 'vertex' AS type, c AS uid, '8:Customer:' || length(c) || ':' || c AS rk,
                  CAST(NULL AS VARCHAR) AS end_uid, CAST(NULL AS DOUBLE) AS o_totalprice FROM m
           UNION ALL SELECT 1, 'edge', NULL, '6:PLACED:8:Customer:' || length(c) || ':' || c || ':5:Order:' || length(o) || ':' || o || ':0:', o, o_totalprice FROM m
           UNION ALL SELECT 2, 'vertex', o, '5:Order:' || length(o) || ':' || o, NULL, o_totalprice FROM m""",
    ),
    "two_hop_counts": (
        two_hop_counts,
        """WITH f AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
           h AS (SELECT l_partkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
                 JOIN part ON p_partkey = l_partkey GROUP BY l_partkey)
           SELECT CAST(s_suppkey AS VARCHAR) AS uid, CAST(sum(n) AS BIGINT) AS n
           FROM supplier JOIN f ON f.l_suppkey = s_suppkey JOIN h ON h.l_partkey = f.l_partkey GROUP BY s_suppkey""",
    ),
}
