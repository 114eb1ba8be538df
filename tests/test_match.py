from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from propgraph import Node, PropertyGraph, Rel, match
from propgraph.operators.elements import distinct_paths
from propgraph.operators.match import (
    bind_path,
    collect_ids,
    count_matches,
    distinct_matches,
    match_vertices,
    top_k,
)
from propgraph.operators.skew import PIECE, cut_heavy, heavy_keys, spread_join

EDGES = [
    ("A", "1", "A", "2", "x"),
    ("A", "1", "A", "2", "y"),  # parallel
    ("A", "2", "A", "3", ""),
    ("A", "3", "A", "1", ""),
    ("A", "1", "A", "1", "loop"),
    ("A", "2", "B", "1", ""),  # the same uid under another label
    ("A", "3", "A", "gone", ""),  # endpoint absent
]
VERTICES = {"A": ["1", "2", "3"], "B": ["1", "9"]}


@pytest.fixture(scope="module")
def graph(spark):
    rows = [(*e, i) for i, e in enumerate(EDGES)]
    edges = spark.createDataFrame(rows, "src_label string, src_uid string, dst_label string, dst_uid string, euid string, n int")
    return PropertyGraph(
        {label: spark.createDataFrame([(u, u * 2) for u in uids], "uid string, name string") for label, uids in VERTICES.items()},
        {"E": edges},
    )


def present(edge):
    return edge[1] in VERTICES[edge[0]] and edge[3] in VERTICES[edge[2]]


@pytest.mark.parametrize("spread", [False, True])
def test_one_hop_is_a_bag_without_dangling_edges(graph, spread):
    rows = match(graph, Node("a"), Rel("f"), Node("b"), spread_hubs=spread)
    got = sorted(tuple(r) for r in rows.select("a_label", "a_uid", "b_label", "b_uid", "f_euid").collect())
    assert got == sorted(e for e in EDGES if present(e))


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("anchor", [None, "a", "b", "c"])
def test_two_hops_use_an_edge_once(graph, anchor, spread):
    uids = {"a": ["1"], "b": ["2", "1"], "c": ["3", "1"]}
    nodes = [Node(v, "A", uids=uids[v] if v == anchor else None) for v in "abc"]
    rows = match(graph, nodes[0], Rel("f", "E"), nodes[1], Rel("g", "E"), nodes[2], spread_hubs=spread)
    got = sorted((r.f_n, r.g_n) for r in rows.select("f_n", "g_n").collect())
    want = []
    for (i, f), (j, g) in itertools.product(enumerate(EDGES), repeat=2):
        if i == j or not present(f) or not present(g) or f[2:4] != g[0:2] or {f[0], f[2], g[2]} != {"A"}:
            continue
        bound = {"a": f[1], "b": f[3], "c": g[3]}
        if anchor is None or bound[anchor] in uids[anchor]:
            want.append((i, j))
    assert got == sorted(want)


@pytest.mark.parametrize("spread", [False, True])
def test_counts_equal_the_matches(spark, graph, spread):
    edges = graph.edge_tables["E"]
    g = PropertyGraph(graph.vertex_tables, {"E": edges, "F": edges.where("n <> 2")})
    pattern = (Node("a"), Rel("f", "E"), Node("b", "A"), Rel("h", "F", where="n > 0"), Node("c", uids=["1", "3"]))
    counted = count_matches(g, *pattern, spread_hubs=spread)
    listed = match(g, *pattern).groupBy("a_label", "a_uid").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, listed.collect())) != []
    with pytest.raises(ValueError):
        count_matches(g, Node("a"), Rel("f", "E"), Node("b"), Rel("h", "E"), Node("c"))


def test_uid_predicate_holds_under_every_label(graph, spark):
    assert sorted(tuple(r) for r in match_vertices(graph, Node("a", uids=["1"])).select("label", "uid").collect()) == [
        ("A", "1"),
        ("B", "1"),
    ]
    ids = spark.createDataFrame([("1",), ("1",), ("none",)], "uid string")
    assert match_vertices(graph, Node("a", uids=ids)).count() == 2
    assert match_vertices(graph, Node("a", uids=[str(i) for i in range(5000)])).count() == 5


def test_properties(graph):
    rows = match(graph, Node("a", "A", where="name = '22'"), Rel("f", "E", where=F.col("n") > 2), Node("b"))
    assert [(r.a_uid, r.b_label, r.f_n) for r in rows.collect()] == [("2", "B", 5)]


def test_pattern_checks(graph):
    with pytest.raises(ValueError):
        match(graph, Node("a"), Rel("f"))
    with pytest.raises(ValueError):
        match(graph, Node("a"), Rel("f"), Node("a"))
    with pytest.raises(ValueError):
        match(graph, Node("a"), Node("f"), Node("b"))
    with pytest.raises(ValueError):
        graph.vertices("None")


def test_paths(graph):
    pattern = (Node("a"), Rel("f"), Node("b"))
    paths = bind_path(match(graph, *pattern), pattern)
    assert {r.n for r in paths.select(F.size("path").alias("n")).collect()} == {3}
    assert paths.count() == 6
    rows = match(graph, *pattern)
    assert distinct_matches(rows.unionByName(rows), pattern).count() == 6
    assert distinct_paths(paths.select("path").unionByName(paths.select("path"))).count() == 6


def test_top_k(spark):
    df = spark.range(10)
    assert [r.id for r in top_k(df, [F.desc("id")], "3").collect()] == [9, 8, 7]
    assert [r.id for r in top_k(df, [F.desc("id")], 1).collect()] == [9]
    assert top_k(df, [F.desc("id")]).count() == 10
    for bad in (1.5, [1], True):
        with pytest.raises(TypeError):
            top_k(df, [F.desc("id")], bad)


def test_top_k_plan(spark):
    plan = top_k(spark.range(10), [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_collect_ids(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("uid"))
    single = collect_ids(ids).collect()
    assert len(single) == 1 and single[0].ids == sorted(str(i) for i in range(1000))
    lists = collect_ids(ids, lists=4).collect()
    assert len(lists) == 4 and max(r.n for r in lists) < 350
    assert sorted(i for r in lists for i in r.ids) == sorted(str(i) for i in range(1000))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join_equals_join(spark, how):
    """A third of all rows on one key, some keys without partner."""
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    other = spark.range(5, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = many.join(other, ["k"], how)
    spread = spread_join(many, other, ["k"], how, rows_per_task=100)
    assert sorted(map(tuple, spread.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_heavy_keys_are_cut_evenly(spark):
    many = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    heavy = heavy_keys(many, ["k"], 1000)
    assert [tuple(r) for r in heavy.collect()] == [(-1, 10)]
    sizes = [r["count"] for r in cut_heavy(many, ["k"], heavy).where("k = -1").groupBy(PIECE).count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 10_000 and max(sizes) < 1300


def test_copies_of_a_row_are_spread(spark):
    copies = spark.range(0, 8000, 1, 8).select(F.lit("k").alias("k"), F.lit("same").alias("v"))
    other = spark.createDataFrame([("k", 1)], "k string, w int")
    pieces = cut_heavy(copies, ["k"], heavy_keys(copies, ["k"], 1000)).groupBy(PIECE).count().collect()
    assert len(pieces) >= 4 and sum(r["count"] for r in pieces) == 8000
    assert spread_join(copies, other, ["k"], rows_per_task=1000).count() == 8000


def test_only_used_columns_are_read(spark, sf_dir):
    from suite.tables import graph as tables

    rows = match(tables(spark, sf_dir), Node("a", "Customer", uids=["1"]), Rel("f", "PLACED"), Node("b", "Order"))
    plan = rows.select("a_uid", "b_uid")._jdf.queryExecution().executedPlan().toString()
    for column in ("c_name", "c_acctbal", "o_totalprice", "o_orderdate"):
        assert column not in plan


def test_counts_of_a_hop_are_joined_as_a_table(spark):
    """The plan of the last hop joins edges with the numbers that were written for the hop before it; nothing below them is
    planned again, so both sides of the join are scans of their own."""
    vertices = {x: spark.createDataFrame([(f"{x}{i}",) for i in range(5)], "uid string") for x in "ABC"}

    def edges(a, b):
        pairs = [(a, f"{a}{i % 5}", b, f"{b}{i % 3}", str(i)) for i in range(20)]
        return spark.createDataFrame(pairs, "src_label string, src_uid string, dst_label string, dst_uid string, euid string")

    g = PropertyGraph(vertices, {"E": edges("A", "B"), "F": edges("B", "C")})
    counts = count_matches(g, Node("a", "A"), Rel("e", "E"), Node("b", "B"), Rel("f", "F"), Node("c", "C"))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and plan.count("Relation") == 1
    # Every edge from A goes to B0, B1 or B2, each of which has four edges.
    ways = {f"A{i}": sum(4 for j in range(20) if j % 5 == i) for i in range(5)}
    assert {r.uid: r.n for r in counts.collect()} == ways


def test_distinct_paths_move_only_what_is_selected(spark, graph):
    """Whole elements, with their properties, take no part in the duplicate check if columns of them are wanted."""
    pattern = (Node("a"), Rel("f"), Node("b"))
    paths = bind_path(match(graph, *pattern), pattern).select("path")
    wanted = [F.col("path")[0]["vertex"]["uid"].alias("a"), F.col("path")[1]["edge"]["rk"].alias("f"), F.size("path").alias("n")]
    whole = distinct_paths(paths.unionByName(paths)).select(*wanted)
    some = distinct_paths(paths.unionByName(paths), select=wanted)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "first(path" not in plan and plan.count("first(") == 3


def test_path_keys_differ_where_paths_do(spark):
    """Row keys that would be equal when put together, absent ones, and elements told apart by kind or properties."""
    element = "struct<kind:string,vertex:struct<rk:string,properties:map<string,variant>>,edge:struct<rk:string,properties:map<string,variant>>>"

    def vertex(rk, p="{}", kind="vertex"):
        return {"kind": kind, "vertex": {"rk": rk, "properties": p}, "edge": None}

    paths = [
        [vertex("1:a"), vertex("b")], [vertex("1:a1:b")], [vertex("1:a"), vertex("b")], [vertex("a", kind="edge")], [vertex("a")],
        [vertex(None, '{"a":1}')], [vertex("", '{"a":1}')], [vertex(None, '{"a":2}')], [vertex('{"a":1}')], [None], [], None,
    ]
    text = element.replace("map<string,variant>", "string")
    rows = spark.createDataFrame([(p,) for p in paths], f"path array<{text}>")
    properties = lambda e: F.try_variant_get(F.parse_json(e["properties"]), "$", "map<string,variant>")
    part = lambda e: F.when(e.isNotNull(), F.struct(e["rk"].alias("rk"), properties(e).alias("properties")))
    whole = lambda e: F.struct(e["kind"].alias("kind"), part(e["vertex"]).alias("vertex"), part(e["edge"]).alias("edge"))
    rows = rows.select(F.transform("path", whole).alias("path"))
    assert distinct_paths(rows).count() == 10


@pytest.mark.parametrize("label", [None, "A"])
def test_ends_without_properties_match_as_joined_ones(spark, label):
    """Endpoints that are no vertex, a vertex twice, null, and nodes that are named or not; edges are not moved for them."""
    a = spark.createDataFrame([("1",), ("2",), ("2",), ("3",), (None,)], "uid string")
    b = spark.createDataFrame([("1",), ("1",), ("4",)], "uid string")
    rows = [(x, u, y, v, f"{n}") for n, (x, u, y, v) in enumerate(itertools.product("AB", ["1", "2", "4", None], "AC", ["1", "2", "9", None]))]
    e = spark.createDataFrame(rows, "src_label string, src_uid string, dst_label string, dst_uid string, euid string")
    g = PropertyGraph({"A": a, "B": b}, {"E": e, "F": e})
    for n in (1, 2):
        listed = []
        for wanted in (True, False):
            nodes = [Node(x, label, properties=wanted) for x in "abc"]
            chain = (nodes[0], Rel("f", "E"), nodes[1], Rel("h", "F"), nodes[2])[: 2 * n + 1]
            found = match(g, *chain)
            ids = [c for c in found.columns if not c.endswith("_properties")]
            listed.append(sorted(map(str, found.select(*ids).collect())))
        assert listed[0] == listed[1] != []


def test_edges_stay_where_they_are_if_their_ends_are_vertices(spark):
    vertices = spark.range(50).select(F.col("id").cast("string").alias("uid"))
    e = spark.range(200).selectExpr("'A' src_label", "string(id % 50) src_uid", "'A' dst_label", "string(id % 7) dst_uid", "string(id) euid")
    g = PropertyGraph({"A": vertices}, {"E": e})
    for label in (None, "A"):
        pattern = (Node("a", label, properties=False), Rel("f"), Node("b", label, properties=False))
        rows = match(g, *pattern)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert rows.count() == 200 and "Join" not in plan and "Aggregate" not in plan
    plan = distinct_matches(rows, pattern)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [a_uid" in plan and distinct_matches(rows, pattern).columns[0] == "a_label"


def test_the_cut_side_is_computed_once(spark):
    """The count of heavy keys and the join read what was written; the rows are not made for each of them."""
    made = spark.sparkContext.accumulator(0)

    def each(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    many = spark.range(0, 1000, 1, 4).selectExpr("id % 10 AS k", "id AS v").mapInArrow(each, "k long, v long")
    other = spark.range(5).selectExpr("id AS k", "id * 10 AS w")
    for how, n in (("left", 1000), ("inner", 500)):
        made.value = 0
        assert len(spread_join(many, other, ["k"], how, rows_per_task=50).collect()) == n and made.value == 1000
