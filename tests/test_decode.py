from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from propgraph.functions.properties import get_property, has_property, pack_properties, set_property
from propgraph.operators.decode import (
    decode_edges,
    decode_path_elements,
    decode_paths,
    decode_result,
    decode_vertices,
    explode_path,
    split,
)
from propgraph.operators.elements import distinct_elements, distinct_paths
from propgraph.sources import export

LABELS = {1: "A", 258: "B"}
KEY_A = [0, 16, 1, 0, 0, 0, 0, 7]
KEY_B = [-1, -15, 2, 0, 0, 0, 1, -1]
VERTEX = {"labels": ["A", "Z"], "entityKey": KEY_A, "properties": {"__uid": "a1", "__tags": ["t"], "x": 1.5, "n": None, "o": {"p": [1]}}}
EDGE = {
    "labels": ["E"],
    "entityKey": [*KEY_A, *KEY_B, 5],
    "startKey": KEY_A,
    "endKey": KEY_B,
    "properties": {"__srcuid": "a1", "__dstuid": "b1", "w": 2},
}
LEGACY = {**EDGE, "startKey": [97, -61, -87, 1, 0], "endKey": [98, 2, 1], "properties": {"w": 2, "__uid": 7}}


def without(doc, *names):
    doc = json.loads(json.dumps(doc))
    for name in names:
        target = doc["properties"] if name.startswith("__") else doc
        del target[name]
    return doc


def docs(spark, *values):
    texts = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(texts, "i int, doc string")


def test_vertex(spark):
    row = decode_vertices(docs(spark, VERTEX), "doc").withColumn("p", F.to_json("properties")).first()
    assert (row.label, row.uid, row.tags, row.entity_key, row.reason) == ("A", "a1", ["t"], KEY_A, None)
    assert row.rk == "0 16 1 0 0 0 0 7"
    assert json.loads(row.p) == {"x": 1.5, "n": None, "o": {"p": [1]}}


def test_vertex_reasons(spark):
    bad = [
        ("oops", "bad_json"),
        (without(VERTEX, "labels"), "no_label"),
        ({**VERTEX, "labels": []}, "no_label"),
        (without(VERTEX, "properties"), "no_properties"),
        (without(VERTEX, "__uid"), "no_uid"),
        (without(VERTEX, "entityKey"), "no_key"),
        (None, None),
        (without(VERTEX, "__tags"), None),
    ]
    decoded = decode_vertices(docs(spark, *(d for d, _ in bad)), "doc")
    assert [r.reason for r in decoded.orderBy("i").collect()] == [reason for _, reason in bad]
    good, rejects = split(decoded)
    assert [(r.i, r.tags, r.uid) for r in good.orderBy("i").collect()] == [(6, None, None), (7, [], "a1")]
    assert rejects.count() == 6


def test_packed_edge(spark):
    row = decode_edges(docs(spark, EDGE), "doc", 18, LABELS).withColumn("p", F.to_json("properties")).first()
    assert (row.label, row.euid, row.src[:], row.dst[:], row.reason) == (
        "E",
        "",
        ("A", "a1", "0 16 1 0 0 0 0 7"),
        ("B", "b1", "-1 -15 2 0 0 0 1 -1"),
        None,
    )
    assert json.loads(row.p) == {"w": 2} and row.rk.endswith(" 5") and row.tags == []


def test_legacy_edge(spark):
    row = decode_edges(docs(spark, LEGACY), "doc", 17, LABELS).withColumn("p", F.to_json("properties")).first()
    assert (row.euid, row.src.label, row.src.uid, row.dst.label, row.dst.uid) == ("7", "A", "aé", "B", "b")
    assert json.loads(row.p) == {"w": 2}


def test_edge_reasons(spark):
    bad = [
        (without(EDGE, "labels"), "no_label"),
        (without(EDGE, "entityKey"), "no_key"),
        (without(EDGE, "properties"), "no_properties"),
        (without(EDGE, "startKey"), "no_start_key"),
        (without(EDGE, "__srcuid"), "no_src_uid"),
        ({**EDGE, "startKey": [0, 0, 99, 0, 0, 0, 0, 0]}, "unknown_start_label"),
        ({**EDGE, "endKey": [1]}, "no_end_key"),
        (without(EDGE, "__dstuid"), "no_dst_uid"),
        ({**EDGE, "endKey": [0, 0, 99, 0, 0, 0, 0, 0]}, "unknown_end_label"),
        (EDGE, None),
    ]
    decoded = decode_edges(docs(spark, *(d for d, _ in bad)), "doc", 18, LABELS)
    assert [r.reason for r in decoded.orderBy("i").collect()] == [reason for _, reason in bad]


def test_paths(spark):
    path = [VERTEX, EDGE, VERTEX]
    values = [path, [], None, "oops", VERTEX, [VERTEX, without(EDGE, "startKey"), VERTEX], [None], [VERTEX, VERTEX]]
    decoded = decode_paths(docs(spark, *values), "doc", 18, LABELS)
    assert [r.reason for r in decoded.orderBy("i").collect()] == [
        None, None, None, "bad_json", "not_a_path", "no_start_key", "no_element", "no_start_key",
    ]
    good, _ = split(decoded)
    long = explode_path(good).orderBy("i", "pos").collect()
    assert [(r.pos, r.kind) for r in long] == [(0, "vertex"), (1, "edge"), (2, "vertex")]
    assert long[0].vertex.uid == "a1" and long[0].edge is None and long[1].edge.dst.uid == "b1"


def test_export_of_decoded_is_the_element(spark):
    vertices = decode_vertices(docs(spark, VERTEX, without(VERTEX, "__tags")), "doc").drop("i", "reason")
    out = [json.loads(r.value) for r in export.vertex_documents(vertices).collect()]
    want = {
        "type": "vertex",
        "label": "A",
        "uid": "a1",
        "RowKeyHexString": "0 16 1 0 0 0 0 7",
        "tags": ["t"],
        "properties": {"x": 1.5, "n": None, "o": {"p": [1]}},
    }
    assert out[0] == want
    assert out[1] == {k: v for k, v in want.items() if k != "tags"}
    edges = decode_edges(docs(spark, {**EDGE, "properties": {"__srcuid": "é", "__dstuid": "b1"}}), "doc", 18, LABELS)
    text = export.edge_documents(edges.drop("i", "reason")).first().value
    assert json.loads(text) == {
        "type": "edge",
        "label": "E",
        "euid": "",
        "startNode": {"type": "vertex", "label": "A", "uid": "é", "RowKeyHexString": "0 16 1 0 0 0 0 7"},
        "endNode": {"type": "vertex", "label": "B", "uid": "b1", "RowKeyHexString": "-1 -15 2 0 0 0 1 -1"},
        "RowKeyHexString": "0 16 1 0 0 0 0 7 -1 -15 2 0 0 0 1 -1 5",
    }
    assert "é" in text
    paths = decode_paths(docs(spark, [VERTEX, EDGE, VERTEX]), "doc", 18, LABELS)
    texts = paths.select(export.path_documents(paths)).first()[0]
    assert [json.loads(t)["type"] for t in texts] == ["vertex", "edge", "vertex"]


def cell(spark, tag, text, expr="c"):
    df = decode_result(spark.createDataFrame([(text,)], "c string"), {"c": tag}, 18, LABELS)
    assert df.schema["c"].metadata == {"graph_type": tag}
    row = df.select(F.expr(expr).alias("c"), "bad_cells").first()
    return row.c, row.bad_cells


@pytest.mark.parametrize(
    "tag, text, value",
    [
        ("boolean", "false", False),
        ("int", "7", 7),
        ("long", "-9007199254740993", -9007199254740993),
        ("double", "1.5", 1.5),
        ("string", "kept", "kept"),
        ("CruxType:List<boolean>", "[true, false, null]", [True, False, None]),
        ("CruxType:List<string>", '["a", "é"]', ["a", "é"]),
        ("CruxType:List<CruxType:List<long>>", "[[1, 2], []]", [[1, 2], []]),
        ("CruxType:Map<string,long>", '{"a": 1}', {"a": 1}),
        ("CruxType:Map<int,CruxType:List<double>>", '{"1": [0.5]}', {1: [0.5]}),
        ("CruxType:Map<string,CruxType:Map<int,string>>", '{"a": {"2": "x"}}', {"a": {2: "x"}}),
    ],
)
def test_values(spark, tag, text, value):
    assert cell(spark, tag, text) == (value, [])
    assert cell(spark, tag, None) == (None, [])


@pytest.mark.parametrize(
    "tag, text",
    [
        ("int", "x"),
        ("CruxType:List<int>", "{"),
        ("CruxType:List<int>", '{"a": 1}'),
        ("CruxType:Map<int,int>", '{"x": 1}'),
        ("CruxType:Map<int,int>", '{"1": 1, "01": 2}'),
        ("GraphNode", "{}"),
        ("CruxType:Path", "[{}]"),
    ],
)
def test_bad_values_are_null_and_named(spark, tag, text):
    assert cell(spark, tag, text) == (None, ["c"])


def test_element_tags(spark):
    for tag in ("CruxType:Node", "GraphNode"):
        assert cell(spark, tag, json.dumps(VERTEX), "c.uid") == ("a1", [])
    for tag in ("CruxType:Relation", "GraphRelation"):
        assert cell(spark, tag, json.dumps(EDGE), "c.dst.label") == ("B", [])
    assert cell(spark, "CruxType:Path", json.dumps([VERTEX, EDGE, VERTEX]), "size(c)") == (3, [])
    assert cell(spark, "CruxType:List<GraphNode>", json.dumps([VERTEX, {}]), "c.uid") == (["a1", None], [])
    assert cell(spark, "CruxType:Map<string,GraphRelation>", json.dumps({"k": EDGE}), "c['k'].src.uid") == ("a1", [])


def test_bad_tags(spark):
    df = spark.createDataFrame([("1",)], "c string")
    assert decode_result(df, {}) is df
    with pytest.raises(ValueError):
        decode_result(df, {"c": "CruxType:List"})


def test_properties(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string").select(
        pack_properties({"a": F.col("a"), "b": F.col("b")}).alias("p")
    )
    p = F.col("p")
    assert [tuple(r) for r in df.select(has_property(p, "a"), get_property(p, "a", "int")).collect()] == [(True, 1), (False, None)]
    updated = df.select(set_property(p, "b", F.lit(2)).alias("p")).select(get_property(p, "b", "int"), F.size(p))
    assert [tuple(r) for r in updated.collect()] == [(2, 2), (2, 1)]
    with pytest.raises(Exception, match="no property"):
        df.select(get_property(p, "a", "int", required=True)).collect()
    null_value = spark.sql("SELECT map('a', parse_json('null')) p").select(has_property(p, "a"), has_property(p, "b")).first()
    assert tuple(null_value) == (True, False)
    assert spark.range(1).select(F.size(pack_properties({}))).first()[0] == 0


def test_distinct_elements(spark):
    elements = spark.sql(
        """SELECT kind, rk, try_variant_get(parse_json(p), '$', 'map<string,variant>') properties FROM VALUES
           ('vertex', '1', '{"a":1}'), ('vertex', '1', '{"a":2}'), ('edge', '1', '{"a":1}'),
           ('vertex', NULL, '{"a":1,"b":2}'), ('vertex', '', '{"b":2,"a":1}'), ('vertex', NULL, '{"a":"1","b":2}')
           AS t(kind, rk, p)"""
    )
    assert sorted((r.kind, r.rk or "") for r in distinct_elements(elements).collect()) == [
        ("edge", "1"),
        ("vertex", ""),
        ("vertex", ""),
        ("vertex", "1"),
    ]


def test_distinct_paths(spark):
    path, other = [VERTEX, EDGE, VERTEX], [VERTEX, EDGE, {**VERTEX, "entityKey": KEY_B}]
    decoded = decode_paths(docs(spark, path, path, other, path[:1]), "doc", 18, LABELS)
    assert sorted(r.n for r in distinct_paths(decoded).select(F.size("path").alias("n")).collect()) == [1, 3, 3]


def test_path_elements(spark):
    values = [[VERTEX, EDGE, VERTEX], [], None, "oops", VERTEX, [VERTEX, without(EDGE, "startKey"), None]]
    rows = decode_path_elements(docs(spark, *values), "doc", 18, LABELS).orderBy("i", "pos").collect()
    assert [(r.i, r.pos, r.kind, r.reason) for r in rows] == [
        (0, 0, "vertex", None),
        (0, 1, "edge", None),
        (0, 2, "vertex", None),
        (3, None, None, "bad_json"),
        (4, None, None, "not_a_path"),
        (5, 0, "vertex", None),
        (5, 1, "edge", "no_start_key"),
        (5, 2, "vertex", "no_element"),
    ]
    assert rows[0].vertex.uid == "a1" and rows[0].edge is None and rows[1].edge.dst.label == "B"
