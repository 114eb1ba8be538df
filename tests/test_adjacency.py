"""Graphs in bucketed tables: same matches, joined without moving edges."""

from __future__ import annotations

import re
import uuid

import pytest

from propgraph import Node, PropertyGraph, Rel, match
from propgraph.graph import ENDPOINT_COLUMNS
from propgraph.operators.load import load_vertices
from propgraph.operators.match import bind_path, count_matches, match_vertices
from propgraph.plans.adjacency import bucket_graph
from propgraph.session import scratch_path
from propgraph.storage import StoredGraph

SCHEMA = ", ".join(f"{c} string" for c in ENDPOINT_COLUMNS) + ", euid string, w int"


@pytest.fixture(scope="module")
def plain(spark):
    people = spark.createDataFrame([(str(i), f"n{i}") for i in range(40)], "uid string, name string")
    towns = spark.createDataFrame([(str(i), i) for i in range(5)], "uid string, size int")
    knows = [("Person", str(i % 37), "Person", str(i * 7 % 45), str(i), i) for i in range(300)]  # some ends are absent
    lives = [("Person", str(i), "Town", str(i % 6), "", i) for i in range(45)]
    return PropertyGraph(
        {"Person": people, "Town of": towns},
        {"knows": spark.createDataFrame(knows, SCHEMA), "lives in": spark.createDataFrame([(a, b, "Town of", *r) for a, b, _, *r in lives], SCHEMA)},
    )


@pytest.fixture(scope="module", params=[1_000_000, 12])
def bucketed(request, spark, plain):
    name = f"g_{uuid.uuid4().hex}"
    g = bucket_graph(spark, plain, name, 8, scratch_path(spark, name), rows_per_task=request.param)
    yield g
    g.drop()
    assert not spark.catalog.databaseExists(name)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


PATTERNS = [
    (Node("a", "Person"), Rel("f", "knows"), Node("b", "Person")),
    (Node("a", "Person", uids=["1", "2", "3", "none"]), Rel("f", "knows"), Node("b", "Person", properties=False)),
    (Node("a", "Person", properties=False), Rel("f", "lives in"), Node("b", "Town of", uids=["1", "4"])),
    (Node("a"), Rel("f"), Node("b", "Town of", where="size > 2")),
    (Node("a", "Person"), Rel("f", "knows"), Node("b", "Person", properties=False), Rel("h", "lives in"), Node("c", "Town of", properties=False)),
    (Node("a", "Person"), Rel("f", "knows"), Node("b", "Person", where="name < 'n2'"), Rel("g", "knows"), Node("c", "Person")),
]


@pytest.mark.parametrize("pattern", PATTERNS, ids=range(len(PATTERNS)))
def test_same_matches(plain, bucketed, pattern):
    want = rows(match(plain, *pattern))
    assert rows(match(bucketed, *pattern)) == want and want
    assert rows(match(bucketed, *pattern, spread_hubs=True, rows_per_task=3)) == want


def test_hubs_have_tables_of_their_own(spark, plain, bucketed):
    knows = {r.dst_uid: r["count"] for r in plain.edge_tables["knows"].groupBy("dst_uid").count().collect()}
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN `{bucketed.database}`").collect()}
    hubs = [n for n in names if n.endswith("_hubs")]
    assert max(knows.values()) < 12 or hubs == [] or "edge_lives_in_in_hubs" not in hubs
    for label, sides in bucketed.edge_names.items():
        for side, parts in sides.items():
            total = sum(bucketed._table(p).count() for p in parts)
            assert total == bucketed.edge_tables[label].count()


def test_counts_of_matches(plain, bucketed):
    pattern = (Node("a", "Person"), Rel("f", "knows"), Node("b", "Person"), Rel("h", "lives in"), Node("c", "Town of"))
    assert rows(count_matches(bucketed, *pattern)) == rows(count_matches(plain, *pattern))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hop_moves_no_edges(spark, plain, no_broadcast):
    g = bucket_graph(spark, plain, f"g_{uuid.uuid4().hex}", 8, scratch_path(spark, "plan"))
    for pattern in (
        (Node("a", "Person"), Rel("f", "knows"), Node("b", "Person", properties=False)),
        (Node("a", "Person", properties=False, uids=["1"]), Rel("f", "knows"), Node("b", "Person", properties=False)),
        (Node("a", "Person", properties=False), Rel("f", "lives in"), Node("b", "Town of", where="size > 2")),
    ):
        text = plan(match(g, *pattern))
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert "Exchange" in plan(match(plain, *pattern))
    # With the properties of the other end, what moves is the joined rows, once.
    text = plan(match(g, *PATTERNS[0]))
    assert text.count("Exchange hashpartitioning") <= 1
    # Four ids prune both sides to the buckets that they are in.
    text = plan(match(g, Node("a", "Person", uids=["1", "2", "3", "4"]), Rel("f", "knows"), Node("b", "Person", properties=False)))
    picked = [int(n) for n in re.findall(r"SelectedBucketsCount: (\d+) out of 8", text)]
    assert len(picked) == 2 and max(picked) <= 4
    g.drop()


def test_written_ids_prune_the_buckets_of_a_stored_graph(spark):
    g = StoredGraph.create(spark, scratch_path(spark, "stored"), "g", {"P": [("n", "int")], "Empty": []}, {}, shards=64)
    source = spark.range(2000).selectExpr("CAST(id AS STRING) AS u", "id AS n")
    g = load_vertices(g, source, "P", [("__uid", "u"), ("n", "n")]).graph
    ids = ["5", "77", "1234", "none", "1999"]
    found = match_vertices(g, Node("a", "P", uids=ids))
    assert sorted(r.uid for r in found.collect()) == ["1234", "1999", "5", "77"]
    folders = {f.rsplit("/", 2)[1] for f in found.inputFiles()}
    assert 1 <= len(folders) <= 5
    assert "PushedFilters: [In(uid" in plan(found)
    assert match_vertices(g, Node("a", "Empty", uids=ids)).count() == 0
    assert match_vertices(g, Node("a", "P", uids=[])).count() == 0
    table = spark.createDataFrame([("5",), ("6",)], "uid string")
    assert match_vertices(g, Node("a", "P", uids=table)).count() == 2


def test_paths_without_properties_read_none(plain):
    pattern = PATTERNS[0]
    chains = match(plain, *pattern)
    bare = bind_path(chains, pattern, properties=False).select("path")
    whole = bind_path(chains, pattern).select("path")
    assert bare.schema == whole.schema
    assert all(len((e.vertex or e.edge).properties) == 0 for r in bare.collect() for e in r.path)
    some = bind_path(chains, pattern, properties=["b"]).select("path").first().path
    assert [len((e.vertex or e.edge).properties) for e in some] == [0, 0, 1]


def test_arguments(spark, plain):
    with pytest.raises(ValueError, match="bucket"):
        bucket_graph(spark, plain, "never", 0)
