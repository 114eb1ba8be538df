"""The driver's tables as one property graph, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import PropertyGraph, edge_table, vertex_table


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def day(column: str):
    """A timestamp's day as text, equal in every session time zone."""
    return F.date_format(column, "yyyy-MM-dd")


def graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    region, nation, customer, supplier, part, orders, lineitem, events = (
        read(spark, sf_dir, t)
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    )
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return PropertyGraph(
        {
            "Region": vertex_table(region, "r_regionkey", "r_name"),
            "Nation": vertex_table(nation, "n_nationkey", "n_name"),
            "Customer": vertex_table(customer, "c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
            "Supplier": vertex_table(supplier, "s_suppkey", "s_name", "s_acctbal"),
            "Part": vertex_table(part, "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
            "Order": vertex_table(
                orders, "o_orderkey", "o_orderstatus", "o_totalprice", day("o_orderdate").alias("o_day"), "o_orderpriority"
            ),
            "User": vertex_table(events.select("user_id").distinct(), "user_id"),
        },
        {
            "IN_REGION": edge_table(nation, "Nation", "n_nationkey", "Region", "n_regionkey"),
            "IN_NATION": edge_table(customer, "Customer", "c_custkey", "Nation", "c_nationkey").unionByName(
                edge_table(supplier, "Supplier", "s_suppkey", "Nation", "s_nationkey")
            ),
            "PLACED": edge_table(
                orders, "Customer", "o_custkey", "Order", "o_orderkey", day("o_orderdate").alias("day"), "o_totalprice"
            ),
            "CONTAINS": edge_table(
                lineitem, "Order", "l_orderkey", "Part", "l_partkey", "l_quantity", "l_returnflag", euid="l_linenumber"
            ),
            "SUPPLIED_BY": edge_table(
                lineitem, "Part", "l_partkey", "Supplier", "l_suppkey", "l_extendedprice", euid=line_id
            ),
            "SUPPLIES": edge_table(
                lineitem.select("l_suppkey", "l_partkey").distinct(), "Supplier", "l_suppkey", "Part", "l_partkey"
            ),
        },
    )


# The same graph as common table expressions: v(label, uid) and e(label, src_label, src_uid, dst_label, dst_uid, euid).
GRAPH_SQL = """
v AS (
  SELECT 'Region' AS label, CAST(r_regionkey AS VARCHAR) AS uid FROM region
  UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'Customer', CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'Supplier', CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'Part', CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'Order', CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT DISTINCT 'User', CAST(user_id AS VARCHAR) FROM events
),
e AS (
  SELECT 'IN_REGION' AS label, 'Nation' AS src_label, CAST(n_nationkey AS VARCHAR) AS src_uid,
         'Region' AS dst_label, CAST(n_regionkey AS VARCHAR) AS dst_uid, '' AS euid FROM nation
  UNION ALL SELECT 'IN_NATION', 'Customer', CAST(c_custkey AS VARCHAR), 'Nation', CAST(c_nationkey AS VARCHAR), '' FROM customer
  UNION ALL SELECT 'IN_NATION', 'Supplier', CAST(s_suppkey AS VARCHAR), 'Nation', CAST(s_nationkey AS VARCHAR), '' FROM supplier
  UNION ALL SELECT 'PLACED', 'Customer', CAST(o_custkey AS VARCHAR), 'Order', CAST(o_orderkey AS VARCHAR), '' FROM orders
  UNION ALL SELECT 'CONTAINS', 'Order', CAST(l_orderkey AS VARCHAR), 'Part', CAST(l_partkey AS VARCHAR),
         CAST(l_linenumber AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'SUPPLIED_BY', 'Part', CAST(l_partkey AS VARCHAR), 'Supplier', CAST(l_suppkey AS VARCHAR),
         l_orderkey || '-' || l_linenumber FROM lineitem
  UNION ALL SELECT DISTINCT 'SUPPLIES', 'Supplier', CAST(l_suppkey AS VARCHAR), 'Part', CAST(l_partkey AS VARCHAR), '' FROM lineitem
)
"""
