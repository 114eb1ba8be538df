"""PageRank against a plain re-computation on graphs that fit on a page."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from propgraph import Node, PropertyGraph, Rel
from propgraph.plans import pagerank as P
from propgraph.plans.views import GraphView, graph_view, materialize
from propgraph.session import child_names, scratch_path

GRAPHS = {
    "cycle": ("abc", [("a", "b"), ("b", "c"), ("c", "a")]),
    "star": ("abcd", [("b", "a"), ("c", "a"), ("d", "a")]),
    "sink and isolated": ("abcx", [("a", "b"), ("b", "c")]),
    "parallel and loop": ("abc", [("a", "b"), ("a", "b"), ("a", "c"), ("b", "b"), ("c", "a")]),
    "hub": (
        "h" + "".join(chr(200 + i) for i in range(40)),
        [("h", chr(200 + i)) for i in range(40)] + [(chr(200 + i), "h") for i in range(0, 40, 3)],
    ),
    "foreign endpoints": ("ab", [("a", "b"), ("a", "z"), ("z", "b"), ("b", "a")]),
}


def brute_force(vertices, edges, sources, damping, rounds):
    edges = [e for e in edges if e[0] in vertices and e[1] in vertices]
    teleport = {v: (1 / len(sources) if v in sources else 0.0) for v in vertices}
    ranks = dict(teleport)
    for _ in range(rounds):
        dangling = sum(r for v, r in ranks.items() if not any(e[0] == v for e in edges))
        new = {v: (1 - damping) * teleport[v] + damping * dangling * teleport[v] for v in vertices}
        for src, dst in edges:
            new[dst] += damping * ranks[src] / sum(e[0] == src for e in edges)
        ranks = new
    return ranks


def view_of(spark, name, fingerprint=""):
    vertices, edges = GRAPHS[name]
    return GraphView(
        spark.createDataFrame([("V", v) for v in vertices], "label string, uid string"),
        spark.createDataFrame(
            [("E", "V", s, "V", d, str(i)) for i, (s, d) in enumerate(edges)],
            "label string, src_label string, src_uid string, dst_label string, dst_uid string, euid string",
        ),
        fingerprint,
    )


def assert_ranks(df, want):
    got = {r.uid: r.rank for r in df.collect()}
    assert got.keys() == want.keys()
    assert got == pytest.approx(want, abs=1e-12)
    assert sum(got.values()) == pytest.approx(1)


@pytest.mark.parametrize("name", GRAPHS)
def test_pagerank(spark, name):
    vertices, edges = GRAPHS[name]
    assert_ranks(P.pagerank(spark, view_of(spark, name), rounds=4), brute_force(vertices, edges, vertices, 0.85, 4))


def test_cycle_stays_even(spark):
    assert {round(r.rank, 12) for r in P.pagerank(spark, view_of(spark, "cycle"), rounds=3).collect()} == {round(1 / 3, 12)}


def test_hub_cut_into_pieces(spark):
    """The hub's edges in more than ten pieces give the same ranks."""
    vertices, edges = GRAPHS["hub"]
    graph = materialize(spark, view_of(spark, "hub"))
    ids = graph.vertices.select("id")
    assert_ranks(P._run(spark, graph, ids, 0.85, 3, None, edges_per_piece=3), brute_force(vertices, edges, vertices, 0.85, 3))


def test_personalized(spark):
    name = "sink and isolated"
    vertices, edges = GRAPHS[name]
    sources = spark.createDataFrame([("a",), ("x",), ("unknown",)], "uid string")
    df = P.personalized_pagerank(spark, view_of(spark, name), sources, damping_factor=0.7, rounds=5)
    assert_ranks(df, brute_force(vertices, edges, "ax", 0.7, 5))


def test_all_sources_is_pagerank(spark):
    view = view_of(spark, "star")
    every = P.personalized_pagerank(spark, view, view.vertices, rounds=3)
    assert {r.uid: r.rank for r in every.collect()} == pytest.approx(
        {r.uid: r.rank for r in P.pagerank(spark, view, rounds=3).collect()}
    )


def test_no_source_is_empty(spark):
    sources = spark.createDataFrame([("unknown",)], "uid string")
    assert P.personalized_pagerank(spark, view_of(spark, "star"), sources).count() == 0


def test_zero_rounds_and_order(spark):
    df = P.pagerank(spark, view_of(spark, "star"), rounds=0)
    assert [r.vid for r in df.collect()] == ["V:a", "V:b", "V:c", "V:d"]
    top = P.pagerank(spark, view_of(spark, "star"), rounds=2, limit="2").collect()
    assert [r.vid for r in top] == ["V:a", "V:b"]


@pytest.mark.parametrize("limit", [1.5, [1], True])
def test_bad_limit(spark, limit):
    with pytest.raises(TypeError):
        P.pagerank(spark, view_of(spark, "star"), limit=limit)


def test_bad_parameters(spark):
    with pytest.raises(ValueError):
        P.pagerank(spark, view_of(spark, "star"), damping_factor=1.5)
    with pytest.raises(ValueError):
        P.pagerank(spark, view_of(spark, "star"), rounds=-1)


def test_view_reuse_needs_the_same_data(spark):
    path = scratch_path(spark, "view")
    first = materialize(spark, view_of(spark, "cycle", "v1"), path)
    same = materialize(spark, view_of(spark, "star", "v1"), path)
    other = materialize(spark, view_of(spark, "star", "v2"), path + "/")
    again = materialize(spark, view_of(spark, "star", "v1"), path, reuse=False)
    assert first.path == same.path != other.path
    # A build of its own; the one that others reuse stays as it is.
    assert again.path not in (first.path, other.path)
    assert materialize(spark, view_of(spark, "cycle", "v1"), path).path == first.path
    assert same.edges.columns == ["src", "dst", "w"]
    assert other.vertices.count() == 4 and again.vertices.count() == 4
    unnamed = [materialize(spark, view_of(spark, n), path).vertices.count() for n in ("cycle", "star")]
    assert unnamed == [3, 4]


def test_view_patterns(spark):
    v = spark.createDataFrame([("1", 5), ("2", 50)], "uid string, x int")
    e = spark.createDataFrame(
        [("A", "1", "A", "2", "", 1.0), ("A", "2", "A", "1", "", 2.0)],
        "src_label string, src_uid string, dst_label string, dst_uid string, euid string, w double",
    )
    graph = PropertyGraph({"A": v, "B": v}, {"E": e})
    view = graph_view(graph, [Node("a", "A", where="x > 10"), Node("b", "A"), Node("c", "B", uids=["1"])], [Rel("f", where=F.col("w") > 1)])
    assert sorted(tuple(r) for r in view.vertices.collect()) == [("A", "1"), ("A", "2"), ("B", "1")]
    assert [r.src_uid for r in view.edges.collect()] == ["2"]
    assert view.fingerprint == ""
    named = [graph_view(graph, [Node("a", "A", where=w)], version="1").fingerprint for w in ("x > 1", "x > 2", "x > 1")]
    assert named[0] == named[2] != named[1]


def test_overlapping_patterns_keep_every_edge_once(spark):
    v = spark.createDataFrame([("1", 5), ("2", 50), ("3", None)], "uid string, x int")
    e = spark.createDataFrame(
        [("A", "1", "A", "2", "", 1.0), ("A", "1", "A", "2", "", 1.0), ("A", "2", "A", "3", "", 9.0)],
        "src_label string, src_uid string, dst_label string, dst_uid string, euid string, w double",
    )
    graph = PropertyGraph({"A": v}, {"E": e})
    ids = spark.createDataFrame([("3",), ("3",), ("2",)], "uid string")
    view = graph_view(
        graph,
        [Node("a", where="x > 1"), Node("b", "A", where="x > 10"), Node("c", "A", uids=ids)],
        [Rel("f", "E", where="w < 5"), Rel("g", where="w < 7")],
    )
    assert sorted(r.uid for r in view.vertices.collect()) == ["1", "2", "3"]
    assert [(r.src_uid, r.dst_uid) for r in view.edges.collect()] == [("1", "2"), ("1", "2")]
    with pytest.raises(ValueError):
        graph_view(graph, [Node("a", "Nope")])


def test_a_graph_made_anew_has_its_own_views(spark):
    """Dropped and created at the same place, with as many loads: the first graph's view is not taken for it."""
    from propgraph.operators.load import load_edges, load_vertices
    from propgraph.storage import StoredGraph

    root, path = scratch_path(spark, "same-place"), scratch_path(spark, "views")
    ranked = []
    for uids in (["1", "2"], ["7", "8", "9"]):
        g = StoredGraph.create(spark, root, "g", {"A": []}, {"E": []}, 1)
        g = load_vertices(g, spark.createDataFrame([(u,) for u in uids], "u string"), "A", [("__uid", "u")]).graph
        edges = spark.createDataFrame([(uids[0], uids[1])], "s string, d string")
        mapping = [("__usid", "s"), ("__udid", "d"), ("__uslabels", "['A']"), ("__udlabels", "['A']")]
        g = load_edges(g, edges, "E", mapping).graph
        ranked.append(sorted(r.uid for r in P.pagerank(spark, graph_view(g), rounds=1, view_path=path).collect()))
        g.drop()
    assert ranked == [["1", "2"], ["7", "8", "9"]]


def test_a_build_that_stops_half_way_is_not_reused(spark, monkeypatch):
    from propgraph.plans import views

    path = scratch_path(spark, "view")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(views, "_number_edges", stop)
        with pytest.raises(RuntimeError):
            materialize(spark, view_of(spark, "cycle", "v1"), path)
    built = materialize(spark, view_of(spark, "star", "v1"), path)
    assert built.vertices.count() == 4 and built.edges.count() > 0


def test_a_run_goes_on_after_its_last_whole_round(spark, monkeypatch):
    """A driver that is lost after three rounds, and one that is lost before a round is noted."""
    graph, run = scratch_path(spark, "view"), scratch_path(spark, "run")
    view, rounds_made = view_of(spark, "parallel and loop", "one"), []
    real, noted = P._round, P.write_once

    def counted(*args):
        rounds_made.append(1)
        if len(rounds_made) == 4:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(P, "_round", counted)
    with pytest.raises(KeyboardInterrupt):
        P.pagerank(spark, view, rounds=8, view_path=graph, run_path=run)

    def unnoted(spark, path, text):
        if "round=4" in path:
            raise KeyboardInterrupt
        return noted(spark, path, text)

    monkeypatch.setattr(P, "write_once", unnoted)
    with pytest.raises(KeyboardInterrupt):
        P.pagerank(spark, view, rounds=8, view_path=graph, run_path=run)
    assert len(rounds_made) == 6  # rounds 4 and 5; the last without its note
    monkeypatch.setattr(P, "write_once", noted)
    whole = [tuple(r) for r in P.pagerank(spark, view, rounds=8, view_path=graph).collect()]
    made = len(rounds_made)
    resumed = [tuple(r) for r in P.pagerank(spark, view, rounds=8, view_path=graph, run_path=run).collect()]
    assert len(rounds_made) - made == 4
    assert [r[0] for r in resumed] == [r[0] for r in whole]
    assert [r[3] for r in resumed] == pytest.approx([r[3] for r in whole], abs=1e-12)
    # A finished run is read, carried on to more rounds, and not taken for fewer rounds or for other arguments.
    made = len(rounds_made)
    assert P.pagerank(spark, view, rounds=8, view_path=graph, run_path=run).count() == len(whole) and len(rounds_made) == made
    more = [tuple(r) for r in P.pagerank(spark, view, rounds=9, view_path=graph, run_path=run).collect()]
    assert len(rounds_made) == made + 1
    assert [r[3] for r in more] == pytest.approx([r[3] for r in P.pagerank(spark, view, rounds=9, view_path=graph).collect()], abs=1e-12)
    made = len(rounds_made)
    few = P.pagerank(spark, view, rounds=2, view_path=graph, run_path=run).collect()
    assert len(rounds_made) == made + 2
    assert [r.rank for r in few] == pytest.approx([r.rank for r in P.pagerank(spark, view, rounds=2, view_path=graph).collect()], abs=1e-12)
    made = len(rounds_made)
    P.pagerank(spark, view, rounds=3, damping_factor=0.5, view_path=graph, run_path=run)
    assert len(rounds_made) == made + 3


def named_edges(view):
    names = {r.id: (r.label, r.uid) for r in view.vertices.collect()}
    return sorted((names[r.src], names[r.dst], r.w) for r in view.edges.collect())


def test_a_view_is_counted_anew_only_where_loads_have_written(spark, monkeypatch):
    from propgraph.operators.load import load_edges, load_vertices
    from propgraph.plans.pairs import delete_old_pairs
    from propgraph.session import child_names
    from propgraph.storage import StoredGraph

    path = scratch_path(spark, "views")
    g = StoredGraph.create(spark, scratch_path(spark, "graph"), "g", {"A": [], "B": []}, {"E": [("n", "int")], "F": []}, 16)
    a, b = [(f"a{i}",) for i in range(20)], [(f"b{i}",) for i in range(10)]
    g = load_vertices(g, spark.createDataFrame(a, "u string"), "A", [("__uid", "u")]).graph
    g = load_vertices(g, spark.createDataFrame(b[:9], "u string"), "B", [("__uid", "u")]).graph
    mapping = [("__usid", "s"), ("__udid", "d"), ("__uslabels", "['A']"), ("__udlabels", "['B']"), ("__uid", "e")]
    rows = [(f"a{i % 20}", f"b{i % 10}", str(i % 7), i % 3) for i in range(300)]

    def load(graph, rows, label="E", more=(("n", "n"),)):
        return load_edges(graph, spark.createDataFrame(rows, "s string, d string, e string, n int"), label, [*mapping, *more]).graph

    def view(graph, where="n > 0"):
        return graph_view(graph, edge_patterns=[Rel("e", "E", where=where), Rel("f", "F")])

    read_buckets = []
    real = StoredGraph.buckets

    def noted(self, kind, label, buckets):
        buckets = list(buckets)
        if kind == "edge":
            read_buckets.extend((label, x) for x in buckets)
        return real(self, kind, label, buckets)

    def build(graph, where="n > 0", counted=None):
        """The refreshed view equals one counted as a whole, and read the buckets in ``counted`` only."""
        made = view(graph, where)
        with monkeypatch.context() as patch:
            patch.setattr(StoredGraph, "buckets", noted)
            read_buckets.clear()
            got = named_edges(materialize(spark, made, path, rows_per_task=5))
        assert got == named_edges(materialize(spark, made, None))
        assert counted is None or set(read_buckets) == counted
        return got

    g = load(g, rows)
    first = build(g)  # the label F has no edges yet
    # One edge more, one that no longer fits the condition, a parallel one, one with a new end: few buckets are written.
    old = g.versions["edge"]["E"]
    s, d, e, _ = next(r for r in rows if r[3] == 1 and r[1] != "b9")
    g = load(g, [("a0", "b0", "new", 5), (s, d, e, 0), (s, d, "again", 1), ("a1", "b9", "x", 1)])
    touched = {("E", x) for x, v in g.versions["edge"]["E"].items() if old.get(x) != v}
    assert 0 < len(touched) <= 4
    assert build(g, counted=touched) != first
    # Vertices that come later give edges their ends; no edges are counted for them.
    g = load_vertices(g, spark.createDataFrame(b[9:], "u string"), "B", [("__uid", "u")]).graph
    assert ("B", "b9") in {end for _, end, _ in build(g, counted=set())}
    # Another label, another condition, an unchanged graph.
    g = load(g, rows[:2], "F", ())
    build(g, counted={("F", x) for x in g.versions["edge"]["F"]})
    build(g, where="n = 2", counted={(x, y) for x in ("E", "F") for y in g.versions["edge"][x]})
    build(g, counted=set())
    pairs = [f"{path}/pairs/{name}" for name in child_names(spark, f"{path}/pairs")]
    assert len(pairs) == 2 and sum(delete_old_pairs(spark, p) for p in pairs) <= 1
    build(load(g, [("a3", "b3", "last", 2)]))


def test_counts_of_two_builds_at_once(spark, monkeypatch):
    """The build that keeps its counts second has right edges all the same."""
    from propgraph.operators.load import load_edges, load_vertices
    from propgraph.plans import pairs
    from propgraph.storage import StoredGraph

    path = scratch_path(spark, "views")
    g = StoredGraph.create(spark, scratch_path(spark, "graph"), "g", {"A": []}, {"E": []}, 4)
    g = load_vertices(g, spark.createDataFrame([(str(i),) for i in range(9)], "u string"), "A", [("__uid", "u")]).graph
    mapping = [("__usid", "s"), ("__udid", "d"), ("__uslabels", "['A']"), ("__udlabels", "['A']")]
    graphs = [g := load_edges(g, spark.createDataFrame([(str(i), "0")], "s string, d string"), "E", mapping).graph for i in (1, 2, 3)]
    empty = (0, {})
    want = [[(("A", str(j)), ("A", "0"), 1) for j in range(1, i + 1)] for i in (1, 2, 3)]
    assert named_edges(materialize(spark, graph_view(graphs[2]), path)) == want[2]
    with monkeypatch.context() as patch:
        patch.setattr(pairs, "_newest", lambda *_: empty)
        assert named_edges(materialize(spark, graph_view(graphs[1]), path)) == want[1]
    assert named_edges(materialize(spark, graph_view(graphs[0]), path)) == want[0]  # an older version of the graph
    nothing = StoredGraph.create(spark, scratch_path(spark, "graph"), "g", {"A": []}, {"E": []}, 4)
    assert named_edges(materialize(spark, graph_view(nothing), path)) == []


@pytest.mark.parametrize("bits", [62, 2])
def test_numbers_that_vertices_share(spark, monkeypatch, bits):
    """Vertices with equal hashes, copies of vertices, null and missing ends: each vertex row counts, with the edges of its own."""
    from propgraph.plans import views

    monkeypatch.setattr(views, "ID_BITS", bits)
    vertices = [("V", "a"), ("V", "b"), ("V", "b"), ("W", "a"), ("V", None), (None, "c"), *(("X", str(i)) for i in range(9))]
    ends = [("V", "a", "V", "b"), ("V", "a", "V", "b"), ("V", "b", "W", "a"), ("V", None, "V", "a"), ("V", "z", "V", "a"), (None, "c", "V", "a")]
    ends += [("X", str(i), "X", str(i + 1)) for i in range(9)]
    v = spark.createDataFrame(vertices, "label string, uid string")
    e = spark.createDataFrame([("E", *x, "") for x in ends], "label string, src_label string, src_uid string, dst_label string, dst_uid string, euid string")
    made = materialize(spark, GraphView(v, e, ""), None)
    assert made.vertices.select("id").distinct().count() == len(vertices) and made.vertices.count() == len(vertices)
    names = {r.id: (r.label, r.uid) for r in made.vertices.collect()}
    got = sorted((*names[r.src], *names[r.dst], r.w) for r in made.edges.collect())
    want = [("V", "a", "V", "b", 2)] * 2 + [("V", "b", "W", "a", 1)] * 2 + [("X", str(i), "X", str(i + 1), 1) for i in range(8)]
    assert got == sorted(want)


def test_edges_are_numbered_without_a_join(spark):
    """Pairs of numbers are shuffled once; no look-up of the ends moves edges."""
    from propgraph.plans import views

    view = view_of(spark, "hub")
    numbered = views._number_edges(spark, view.edges.withColumn("w", F.lit(1).cast("bigint")), view.vertices, False, 10)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1


def write_supplies(spark, folder, parts=12, suppliers=4):
    """The tables of the suite's graph, with few rows."""
    lines = [(i // 3, (i * i + i // 5) % parts, (i * 7 + i // 4) % suppliers, i % 3, 1.0, 5.0 + i, "N") for i in range(60)]
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(0, "C", 0, 1.0, "M")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": (
            [(i, f"S{i}", 0, 1.0) for i in range(suppliers)],
            "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        ),
        "part": (
            [(i, f"P{i}", "B", "T", i, 1.0) for i in range(parts)],
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "orders": (
            [(i, 0, "F", 1.0, None, "1") for i in range(20)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            lines,
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_returnflag string",
        ),
        "events": ([(0,), (1,)], "user_id bigint"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return f"{folder}"


def test_top_ranks_are_those_of_a_whole_run(spark, tmp_path):
    """The first ten of all ranks, after as many rounds."""
    from suite.algorithm_queries import pagerank_supply, pagerank_topk

    folder = write_supplies(spark, tmp_path)
    whole = [tuple(r) for r in pagerank_supply(spark, folder).collect()]
    assert len(whole) == 16
    assert [tuple(r) for r in pagerank_topk(spark, folder).collect()] == whole[:10]


def view_from(spark, vertices, edges, fingerprint=""):
    return GraphView(
        spark.createDataFrame([("V", v) for v in vertices], "label string, uid string"),
        spark.createDataFrame(
            [("E", "V", s, "V", d, str(i)) for i, (s, d) in enumerate(edges)],
            "label string, src_label string, src_uid string, dst_label string, dst_uid string, euid string",
        ),
        fingerprint,
    )


def rounds_kept(spark, run):
    """The uids that the rounds of the one run below ``run`` have written, round by round."""
    (name,) = child_names(spark, run)
    (view,) = [f for f in child_names(spark, f"{run}-view/one") if f != "ready"]
    ids = spark.read.parquet(f"{run}-view/one/{view}/vertices")
    n = sum(f.isdigit() for f in child_names(spark, f"{run}/{name}"))
    return [sorted(r.uid for r in spark.read.parquet(f"{run}/{name}/{i}").join(ids, "id").collect()) for i in range(n)]


def test_only_vertices_that_paths_reach_move_in_a_round(spark):
    """Vertices that no edge leads to are silent after the first round, those behind them one round later."""
    run = scratch_path(spark, "run")
    vertices, edges = "pqrstxyz", [("p", "s"), ("q", "s"), ("r", "t"), ("s", "x"), ("t", "x"), ("x", "y"), ("y", "x"), ("y", "z")]
    view = view_from(spark, vertices, edges, "one")
    df = P.pagerank(spark, view, rounds=4, view_path=f"{run}-view", run_path=run)
    assert_ranks(df, brute_force(vertices, edges, vertices, 0.85, 4))
    assert rounds_kept(spark, run) == [list("stxyz"), list("xyz"), list("xyz"), list("xyz")]


def test_ranks_are_rounded_once_each(spark):
    """The order is by a column, not by an expression that each comparison computes again."""
    plan = P.pagerank(spark, view_of(spark, "cycle"), rounds=1)._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "round(" not in sorts[0]


@pytest.mark.parametrize("sources, damping", [("abcdefghijklmnopqrst", 0.85), ("cd", 0.6)])
def test_edges_by_source_and_by_target(spark, monkeypatch, sources, damping):
    """Sources of more than four targets have their edges laid out by target, also where all are sent by a join."""
    rng, vertices = random.Random(7), "abcdefghijklmnopqrst"
    edges = [(s, d) for s in vertices[:15] for d in rng.choices(vertices, k=rng.choice((1, 2, 3, 9, 14)))]
    laid_out, real = [], P._lay_out

    def noted(*args):
        tables = real(*args)
        laid_out.append([t.count() for t in tables])
        return tables

    monkeypatch.setattr(P, "_lay_out", noted)
    graph = materialize(spark, view_from(spark, vertices, edges))
    ids = graph.vertices.where(F.col("uid").isin(*sources)).select("id")
    want = brute_force(vertices, edges, sources, damping, 5)
    assert_ranks(P._run(spark, graph, ids, damping, 5, None, edges_per_piece=4), want)
    monkeypatch.setattr(P, "WIDE_SOURCES", 0)
    assert_ranks(P._run(spark, graph, ids, damping, 5, None, edges_per_piece=4), want)
    assert laid_out[0] == laid_out[1] and min(laid_out[0]) > 0 and sum(laid_out[0]) == len(set(edges))


def test_few_sources_move_few_vertices(spark):
    run = scratch_path(spark, "run")
    vertices, edges = "pqsxyz", [("p", "s"), ("q", "s"), ("s", "x"), ("x", "y"), ("y", "x"), ("y", "z"), ("q", "z")]
    sources = spark.createDataFrame([("p",), ("no such id",)], "uid string")
    df = P.personalized_pagerank(
        spark, view_from(spark, vertices, edges, "one"), sources, rounds=4, view_path=f"{run}-view", run_path=run
    )
    assert_ranks(df, brute_force(vertices, edges, "p", 0.85, 4))
    assert rounds_kept(spark, run) == [["s"], ["x"], ["y"], ["x", "z"]]


def test_edges_of_a_source_lie_side_by_side(spark, monkeypatch):
    """In one file of the view, sorted; not if one has too many for a task, with the same edges."""
    from propgraph.plans import views

    rng, vertices = random.Random(3), [f"v{i}" for i in range(40)]
    made = view_from(spark, vertices, [(rng.choice(vertices), rng.choice(vertices)) for _ in range(400)])
    graph = materialize(spark, made, None)
    rows = graph.edges.select("src", F.input_file_name().alias("file")).collect()
    files = {}
    for r in rows:
        files.setdefault(r.file, []).append(r.src)
    assert all(sources == sorted(sources) for sources in files.values())
    assert len({(r.src, r.file) for r in rows}) == len({r.src for r in rows})
    plans, real = [], views._number_edges
    monkeypatch.setattr(views, "ROWS_PER_SOURCE", 3)
    monkeypatch.setattr(views, "_number_edges", lambda *args: plans.append(real(*args)) or plans[-1])
    assert named_edges(materialize(spark, made, None)) == named_edges(graph)
    assert "Repartition" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()
