from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from propgraph.operators.load import (
    check_edge_mapping,
    check_vertex_mapping,
    endpoint_label,
    latest_per_key,
    load_edges,
    load_vertices,
)
from propgraph.session import path_exists, scratch_path
from propgraph.sources.tables import create_table, read_delimited, read_delimited_rejects, sql
from propgraph.storage import StoredGraph

MODULE = [("__uid", "uid"), ("name", "name"), ("size", "size")]
CONTAINER = [("__usid", "s"), ("__udid", "d"), ("__uslabels", "['Module']"), ("__udlabels", "[dl]")]


@pytest.fixture
def graph(spark):
    return StoredGraph.create(
        spark,
        scratch_path(spark, "test-graph"),
        "modules",
        {"Module": [("name", "string"), ("size", "int"), ("kernel", "string")], "Bare": []},
        {"Container": [], "Weighted": [("w", "double")]},
        shards=3,
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def report(result):
    return {(r.outcome, r.reason): r.n for r in result.report.collect()}


def modules(spark, *values):
    return spark.createDataFrame(list(values), "uid string, name string, size int")


def test_new_graph_is_empty(spark, graph):
    assert graph.vertices().count() == 0 and graph.edges().count() == 0
    assert StoredGraph.open(spark, graph.root).schema == graph.schema
    with pytest.raises(ValueError):
        StoredGraph.create(spark, graph.root, "again", {"A": []}, {}, 1)


def test_upsert(spark, graph):
    first = load_vertices(graph, modules(spark, ("1", "a", 1), ("2", "b", 2), (None, "x", 0)), "Module", MODULE)
    assert report(first) == {
        ("inserted", None): 2,
        ("updated", None): 0,
        ("superseded", None): 0,
        ("rejected", "no_uid"): 1,
    }
    # Only the name is mapped: the size stays; a null overwrites.
    second = load_vertices(first.graph, modules(spark, ("2", None, 9), ("3", "c", 9)), "Module", MODULE[:2])
    assert report(second)[("inserted", None)] == 1 and report(second)[("updated", None)] == 1
    table = second.graph.vertex_tables["Module"]
    assert rows(table, "uid", "name", "size", "kernel") == [
        ("1", "a", 1, None),
        ("2", None, 2, None),
        ("3", "c", None, None),
    ]
    # A reader keeps the version it opened.
    assert first.graph.vertex_tables["Module"].count() == 2
    assert StoredGraph.open(spark, graph.root).vertex_tables["Module"].count() == 3


def test_upsert_twice_is_upsert_once(spark, graph):
    batch = modules(spark, ("1", "a", 1), ("2", "b", None))
    once = load_vertices(graph, batch, "Module", MODULE)
    twice = load_vertices(once.graph, batch, "Module", MODULE)
    assert rows(once.graph.vertex_tables["Module"], "*") == rows(twice.graph.vertex_tables["Module"], "*")
    assert report(twice)[("updated", None)] == 2 and report(twice)[("inserted", None)] == 0


def test_disjoint_upserts_equal_one(spark, graph):
    a, b = modules(spark, ("1", "a", 1)), modules(spark, ("2", "b", 2))
    step = load_vertices(load_vertices(graph, a, "Module", MODULE).graph, b, "Module", MODULE).graph
    other = StoredGraph.create(
        spark, scratch_path(spark, "g"), "g", {"Module": [("name", "string"), ("size", "int"), ("kernel", "string")]}, {}, 1
    )
    both = load_vertices(other, a.unionByName(b), "Module", MODULE).graph
    assert rows(step.vertex_tables["Module"], "*") == rows(both.vertex_tables["Module"], "*")


def test_duplicates_in_one_batch(spark, graph):
    batch = modules(spark, ("1", "a", 5), ("1", "b", None), ("1", "b", 1), ("1", None, 9))
    by_values = load_vertices(graph, batch, "Module", MODULE)
    assert rows(by_values.graph.vertex_tables["Module"], "name", "size") == [("b", 1)]
    assert report(by_values)[("superseded", None)] == 3
    by_size = load_vertices(by_values.graph, batch, "Module", MODULE, order_by=["size"])
    assert rows(by_size.graph.vertex_tables["Module"], "name", "size") == [(None, 9)]


def test_hot_key_combines_before_the_shuffle(spark):
    rows_ = spark.range(1000).select(F.lit("hub").alias("uid"), F.col("id").alias("v"))
    best = latest_per_key(rows_, ["uid"], ["v"], [])
    assert [tuple(r) for r in best.collect()] == [("hub", 999, 1000)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.index("partial_max") > plan.index("Exchange")


def test_values_without_order(spark):
    rows_ = spark.sql("SELECT 'a' uid, map('k', x) m, x n FROM VALUES (1), (3), (2) t(x)")
    assert [tuple(r) for r in latest_per_key(rows_, ["uid"], ["m"], []).select("m").collect()] == [({"k": 3},)]


def test_edges(spark, graph):
    g = load_vertices(graph, modules(spark, ("1", "a", 1)), "Module", MODULE).graph
    batch = spark.createDataFrame(
        [("1", "1", "Module", "p"), ("1", "2", "Module", "q"), ("1", "1", "Module", "q"), ("1", None, "Module", "q"), ("1", "1", None, "")],
        "s string, d string, dl string, e string",
    )
    plain = load_edges(g, batch, "Container", CONTAINER)
    assert report(plain) == {
        ("inserted", None): 2,
        ("updated", None): 0,
        ("superseded", None): 1,
        ("rejected", "no_dst_uid"): 1,
        ("rejected", "no_dst_label"): 1,
        ("dangling", "no_src_vertex"): 0,
        ("dangling", "no_dst_vertex"): 1,
    }
    with_ids = load_edges(plain.graph, batch, "Container", [*CONTAINER, ("__uid", "e")])
    assert rows(with_ids.graph.edge_tables["Container"], "src_uid", "dst_uid", "euid") == [
        ("1", "1", ""),
        ("1", "1", "p"),
        ("1", "1", "q"),
        ("1", "2", ""),
        ("1", "2", "q"),
    ]


def test_concurrent_loads_collide(spark, graph):
    batch = modules(spark, ("1", "a", 1))
    load_vertices(graph, batch, "Module", MODULE)
    with pytest.raises(Exception, match="(?i)already exists"):
        load_vertices(graph, batch, "Module", MODULE)


@pytest.mark.parametrize("mapping", [[], [("name", "name")], [("name", "n"), ("__uid", "uid")]])
def test_bad_vertex_mapping(mapping):
    with pytest.raises(ValueError):
        check_vertex_mapping(mapping)


@pytest.mark.parametrize("mapping", [[], CONTAINER[:3], [CONTAINER[1], CONTAINER[0], *CONTAINER[2:]]])
def test_bad_edge_mapping(mapping):
    with pytest.raises(ValueError):
        check_edge_mapping(mapping)


def test_endpoint_labels(spark):
    df = spark.createDataFrame([("L",)], "c string")
    assert df.select(endpoint_label("[c]"), endpoint_label("['vertex']"), endpoint_label('["v"]')).first()[:] == ("L", "vertex", "v")
    with pytest.raises(ValueError):
        endpoint_label("vertex")


def test_undeclared(spark, graph):
    batch = modules(spark, ("1", "a", 1))
    with pytest.raises(ValueError):
        load_vertices(graph, batch, "Module", [("__uid", "uid"), ("nope", "name")])
    with pytest.raises(ValueError):
        load_vertices(graph, batch, "Nope", MODULE)


def test_stored_filter_reaches_the_scan(spark, graph):
    from propgraph import Node
    from propgraph.operators.match import match_vertices

    g = load_vertices(graph, modules(spark, ("1", "a", 1), ("2", "b", 2)), "Module", MODULE).graph
    df = match_vertices(g, Node("a", "Module", uids=["2"])).select("uid")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(uid,2)" in plan and "ReadSchema: struct<uid:string>" in plan
    assert df.count() == 1


def test_delete_old_versions(spark, graph):
    g = graph
    for i in range(3):
        g = load_vertices(g, modules(spark, ("1", "a", i)), "Module", MODULE).graph
    assert g.delete_old_versions() == 2 and g.delete_old_versions() == 0
    assert rows(StoredGraph.open(spark, g.root).vertex_tables["Module"], "uid", "size") == [("1", 2)]


def test_a_load_rewrites_only_the_buckets_it_touches(spark, graph):
    g = load_vertices(graph, modules(spark, *((str(i), "a", i) for i in range(60))), "Module", MODULE).graph
    before = dict(g.versions["vertex"]["Module"])
    assert len(before) == 3
    g = load_vertices(g, modules(spark, ("7", "b", 700), (None, "x", 1)), "Module", MODULE).graph
    after = g.versions["vertex"]["Module"]
    assert sum(after[b] != before[b] for b in before) == 1
    assert rows(g.vertex_tables["Module"].where("size >= 59"), "uid", "size") == [("59", 59), ("7", 700)]
    assert g.vertex_tables["Module"].count() == 60
    assert g.delete_old_versions() == 1 and StoredGraph.open(spark, g.root).vertex_tables["Module"].count() == 60


def test_drop(spark, graph):
    load_vertices(graph, modules(spark, ("1", "a", 1)), "Module", MODULE)
    graph.drop()
    assert not path_exists(spark, graph.root)
    with pytest.raises(ValueError):
        StoredGraph.open(spark, graph.root)


def test_delimited_text(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("1;a;x",), ("2;b;",), ("bad;c;é",)], "value string").write.text(path)
    columns = [("uid", "int"), ("name", "string"), ("note", "string")]
    got = rows(read_delimited(spark, path, columns, ";"), "*")
    assert got == [(1, "a", "x"), (2, "b", None), (None, "c", "é")]
    for stored_as in ("textfile", "csvfile"):
        table = create_table(spark, path, f"t_{stored_as}", columns, stored_as, ";")
        assert rows(table, "*") == got
    assert sql(spark, "SELECT count(*) AS n FROM t_textfile", database="default").first().n == 3
    with pytest.raises(ValueError):
        create_table(spark, path, "t_other", columns, "avro")


def test_names_of_a_load_are_free_for_properties(spark):
    g = StoredGraph.create(spark, scratch_path(spark, "names"), "n", {"A": [("reason", "string"), ("label", "string"), ("x", "int")]}, {}, 1)
    source = spark.createDataFrame([("1", "r", "l", "5"), ("2", "s", "m", "no")], "u string, r string, l string, x string")
    result = load_vertices(g, source, "A", [("__uid", "u"), ("reason", "r"), ("label", "l"), ("x", "x")])
    assert rows(result.graph.vertex_tables["A"], "uid", "reason", "label", "x") == [("1", "r", "l", 5), ("2", "s", "m", None)]
    assert report(result)[("cell does not fit", "x")] == 1
    bad = spark.createDataFrame([("1", "oops")], "u string, x string")
    again = load_vertices(result.graph, bad, "A", [("__uid", "u"), ("x", "x")])
    assert rows(again.graph.vertex_tables["A"].where("uid = '1'"), "x") == [(5,)]
    with pytest.raises(ValueError):
        StoredGraph.create(spark, scratch_path(spark, "names"), "n", {"A": [("__x", "int")]}, {}, 1)


def test_report_does_not_read_the_source_again(spark, graph):
    source = spark.createDataFrame([("1", "2", "Module"), ("1", None, "Module")], "s string, d string, dl string")
    path = scratch_path(spark, "edges-source")
    source.write.parquet(path)
    result = load_edges(graph, spark.read.parquet(path), "Container", CONTAINER)
    assert path not in result.report._jdf.queryExecution().optimizedPlan().toString()
    assert path.rsplit("/", 1)[1] not in str(result.report.inputFiles())
    assert report(result)[("rejected", "no_dst_uid")] == 1 and report(result)[("dangling", "no_src_vertex")] == 1


def test_an_interrupted_publish_does_not_block_the_next(spark, graph):
    from propgraph.session import _hadoop_path

    fs, half_written = _hadoop_path(spark, f"{graph.root}/meta/_interrupted")
    fs.create(half_written, False).close()
    loaded = load_vertices(graph, modules(spark, ("1", "a", 1)), "Module", MODULE).graph
    assert StoredGraph.open(spark, graph.root).meta_version == loaded.meta_version == 2


def test_stored_uid_predicate_is_pushed(spark, sf_dir):
    from suite.stored_queries import stored_match_uid_in

    plan = stored_match_uid_in(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "In(uid, [" in plan


def test_a_property_is_mapped_once():
    with pytest.raises(ValueError, match="more than once: name"):
        check_vertex_mapping([("__uid", "u"), ("name", "a"), ("name", "b")])
    edge = [("__usid", "s"), ("__udid", "d"), ("__uslabels", "['A']"), ("__udlabels", "['B']")]
    with pytest.raises(ValueError, match="more than once: W, w"):
        check_edge_mapping([*edge, ("w", "a"), ("W", "b")])
    check_edge_mapping([*edge, ("__uid", "a"), ("w", "b")])


def test_rejects_of_delimited_text(spark, tmp_path):
    text = '1,a,2.5\nx,b,1\n2,"q,r",\n3,c\n4,d,1,9\n\n,,\n5,"un,1\n6,e,zz\n'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(text)
    columns = [("id", "int"), ("name", "string"), ("x", "double")]
    good, rejects = read_delimited_rejects(spark, str(tmp_path / "in"), columns)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", 2.5), (2, "q,r", None), (None, None, None)], key=str)
    lines = ["3,c", "4,d,1,9", '5,"un,1', "6,e,zz", "x,b,1"]
    assert sorted(r.line for r in rejects.collect()) == lines
    # Whatever a query needs of the rows, the same lines fit.
    assert sorted(r.line for r in rejects.select("line").collect()) == lines and rejects.count() == 5
    assert good.select("name").count() == good.count() == 3
    assert rejects.select("file").distinct().count() == 1
    with pytest.raises(ValueError):
        read_delimited_rejects(spark, str(tmp_path / "in"), [("__line", "string")])


def test_views_of_a_stored_graph(spark, graph):
    source = spark.createDataFrame([("a", "x", 1)], "uid string, name string, size int")
    loaded = load_vertices(graph, source, "Module", MODULE).graph
    names = loaded.register()
    assert "modules_label_dict" in names and "modules_edge_Container" in names
    assert [tuple(r) for r in spark.sql("SELECT uid, name, size FROM modules_vertex_Module").collect()] == [("a", "x", 1)]
    assert {r.label for r in spark.sql("SELECT label_value AS label FROM modules_label_dict").collect()} == {"Module", "Bare", "Container", "Weighted"}
    # A newer version takes the names over.
    more = spark.createDataFrame([("b", "y", 2)], "uid string, name string, size int")
    newer = load_vertices(loaded, more, "Module", MODULE).graph
    newer.register()
    assert spark.sql("SELECT * FROM modules_vertex_Module").count() == 2
    newer.drop()
    assert not any(t.name.lower().startswith("modules_") for t in spark.catalog.listTables())
