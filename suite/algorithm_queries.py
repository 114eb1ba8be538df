"""Views, PageRank and personalized PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import Node, Rel, match
from propgraph.plans.pagerank import pagerank, personalized_pagerank
from propgraph.plans.views import GraphView, graph_view, materialize
from propgraph.session import scratch_path
from suite.tables import GRAPH_SQL, graph


def rounded(ranks: DataFrame) -> DataFrame:
    """Ten digits; the last ones of a distributed sum are not reproducible."""
    return ranks.select("vid", F.round("rank", 10).alias("rank"))


def supply_view(spark: SparkSession, sf_dir: str) -> GraphView:
    """Parts and suppliers with the edges between them."""
    return graph_view(
        graph(spark, sf_dir),
        [Node("a", "Part"), Node("b", "Supplier")],
        [Rel("f", "SUPPLIED_BY"), Rel("h", "SUPPLIES")],
        version=sf_dir,
    )


def graph_view_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view by property conditions, queried through SQL. Edges to vertices outside the view do not count."""
    view = graph_view(
        graph(spark, sf_dir),
        [Node("a", "Part", where="p_size > 20"), Node("b", "Supplier", where="s_acctbal > 0")],
        [Rel("f", "SUPPLIED_BY", where="l_extendedprice > 1000")],
    )
    view.register("supply")
    return spark.sql(
        """SELECT e.src_uid AS part, e.dst_uid AS supplier, count(*) AS edges FROM supply_edges e
           JOIN supply_vertices a ON a.label = e.src_label AND a.uid = e.src_uid
           JOIN supply_vertices b ON b.label = e.dst_label AND b.uid = e.dst_uid
           GROUP BY e.src_uid, e.dst_uid"""
    )


def graph_view_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialize a view, take it a second time from its path, and name its weighted edges."""
    path = scratch_path(spark, "shared-view")
    view = supply_view(spark, sf_dir)
    first = materialize(spark, view, path, rows_per_task=400)
    again = materialize(spark, view, path, reuse=True)
    if again.path != first.path:
        raise AssertionError("the view was not reused")
    src = again.vertices.select(F.col("id").alias("src"), F.col("label").alias("src_label"), F.col("uid").alias("src_uid"))
    dst = again.vertices.select(F.col("id").alias("dst"), F.col("label").alias("dst_label"), F.col("uid").alias("dst_uid"))
    return again.edges.join(src, "src").join(dst, "dst").select("src_label", "src_uid", "dst_label", "dst_uid", "w")


def pagerank_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(spark, supply_view(spark, sf_dir), edges_per_piece=400))


def pagerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(spark, supply_view(spark, sf_dir), limit="10"))


def pagerank_whole_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labels: vertices without out-edges (regions) and without edges (users) included."""
    return rounded(pagerank(spark, graph_view(graph(spark, sf_dir))))


def personalized_pagerank_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources: the suppliers of one region, found by a match."""
    g = graph(spark, sf_dir)
    found = match(
        g,
        Node("s", "Supplier"),
        Rel("f", "IN_NATION"),
        Node("n", "Nation"),
        Rel("h", "IN_REGION"),
        Node("r", "Region", where="r_name = 'ASIA'"),
    )
    sources = found.select(F.col("s_label").alias("label"), F.col("s_uid").alias("uid"))
    return rounded(personalized_pagerank(spark, supply_view(spark, sf_dir), sources))


def personalized_pagerank_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by uid under every label, one of them unknown; the whole graph has dangling vertices."""
    sources = spark.createDataFrame([("1",), ("2",), ("no such id",)], "uid string")
    return rounded(personalized_pagerank(spark, graph_view(graph(spark, sf_dir)), sources, rounds=4))


def rank_sql(vertices: str, edges: str, sources: str, rounds: int, damping: float = 0.85, tail: str = "") -> str:
    """The same iteration as a recursive query over vs(id), es(src, dst) and the teleport vertices ss(id)."""
    return f"""
WITH RECURSIVE {GRAPH_SQL},
vs AS MATERIALIZED ({vertices}),
es AS MATERIALIZED (
  SELECT a.src, a.dst, count(*) AS w FROM ({edges}) a JOIN vs x ON x.id = a.src JOIN vs y ON y.id = a.dst GROUP BY 1, 2),
ow AS MATERIALIZED (SELECT src, sum(w) AS o FROM es GROUP BY src),
ss AS MATERIALIZED ({sources}),
t AS MATERIALIZED (
  SELECT vs.id, CASE WHEN ss.id IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / (SELECT count(*) FROM ss) END AS t
  FROM vs LEFT JOIN ss ON ss.id = vs.id),
pr(i, id, r) AS (
  SELECT 0, id, t FROM t
  UNION ALL
  SELECT * FROM (
    WITH c AS (SELECT es.dst AS id, sum(pr.r * es.w / ow.o) AS s
               FROM pr JOIN ow ON ow.src = pr.id JOIN es ON es.src = pr.id GROUP BY es.dst),
         m AS (SELECT coalesce(sum(pr.r), 0) AS d FROM pr LEFT JOIN ow ON ow.src = pr.id WHERE ow.src IS NULL),
         n AS (SELECT max(i) AS i FROM pr)
    SELECT n.i + 1, t.id, (1 - {damping}) * t.t + {damping} * (coalesce(c.s, 0) + t.t * m.d)
    FROM t LEFT JOIN c ON c.id = t.id, m, n WHERE n.i < {rounds}))
SELECT id AS vid, round(r, 10) AS rank FROM pr WHERE i = {rounds} {tail}"""


_SUPPLY_V = "SELECT label || ':' || uid AS id FROM v WHERE label IN ('Part', 'Supplier')"
_ALL_V = "SELECT label || ':' || uid AS id FROM v"
_SUPPLY_E = (
    "SELECT src_label || ':' || src_uid AS src, dst_label || ':' || dst_uid AS dst FROM e"
    " WHERE label IN ('SUPPLIED_BY', 'SUPPLIES')"
)
_ALL_E = "SELECT src_label || ':' || src_uid AS src, dst_label || ':' || dst_uid AS dst FROM e"

QUERIES = {
    "graph_view": (
        graph_view_edges,
        """SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supplier, count(*) AS edges
           FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
           WHERE l_extendedprice > 1000 AND p_size > 20 AND s_acctbal > 0 GROUP BY l_partkey, l_suppkey""",
    ),
    "graph_view_reuse": (
        graph_view_reuse,
        f"""WITH {GRAPH_SQL}
            SELECT src_label, src_uid, dst_label, dst_uid, count(*) AS w FROM e
            WHERE label IN ('SUPPLIED_BY', 'SUPPLIES') GROUP BY ALL""",
    ),
    "pagerank": (pagerank_supply, rank_sql(_SUPPLY_V, _SUPPLY_E, "SELECT id FROM vs", 10)),
    "pagerank_topk": (
        pagerank_topk,
        rank_sql(_SUPPLY_V, _SUPPLY_E, "SELECT id FROM vs", 10, tail="ORDER BY rank DESC, vid LIMIT 10"),
    ),
    "pagerank_whole_graph": (pagerank_whole_graph, rank_sql(_ALL_V, _ALL_E, "SELECT id FROM vs", 10)),
    "personalized_pagerank": (
        personalized_pagerank_supply,
        rank_sql(
            _SUPPLY_V,
            _SUPPLY_E,
            "SELECT 'Supplier:' || s_suppkey AS id FROM supplier JOIN nation ON n_nationkey = s_nationkey"
            " JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'",
            10,
        ),
    ),
    "personalized_pagerank_ids": (
        personalized_pagerank_ids,
        rank_sql(_ALL_V, _ALL_E, "SELECT label || ':' || uid AS id FROM v WHERE uid IN ('1', '2', 'no such id')", 4),
    ),
}
