from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from propgraph import PropertyGraph
from propgraph.operators.profile import profile_endpoints, profile_vertices, schema_from_data
from propgraph.schema import GraphSchema, dictionary_problems, label_column, parse_schema_documents, resolve_labels, schema_documents

GOOD = {
    "__VERSION": 18,
    "graph.name": "g",
    "graph.index.type": "native",
    "graph.replication.number": "3",
    "graph.shard.number": 5,
    "vertex.tables": [{"label.index": 1, "label.value": "A"}],
    "edge.tables": [],
}


def parse(spark, *docs):
    texts = [(d if d is None or isinstance(d, str) else json.dumps(d),) for d in docs]
    return parse_schema_documents(spark.createDataFrame(texts, "doc string"), "doc")


def test_declare(spark):
    schema = GraphSchema.declare("g", {"A": [("x", "int")], "B": []}, {"E": [("w", "decimal(10,2)")]}, 3)
    assert schema.vertex_type("A").simpleString() == "struct<uid:string,x:int>"
    assert schema.vertex_label(2) == "B" and schema.vertex_label(3) is None and schema.edge_label(1) == "E"
    doc = json.loads(schema.document())
    assert doc["graph.shard.number"] == 3 and doc["graph.replication.number"] == 3
    assert "graph.encryption.type" not in doc and "graph.index.separated" not in doc
    assert GraphSchema.from_meta(json.loads(json.dumps(schema.to_meta()))) == schema
    with pytest.raises(ValueError):
        GraphSchema.declare("g", {"A": [("uid", "int")]}, {}, 1)
    with pytest.raises(ValueError):
        GraphSchema.declare("g", {"A": [("x", "int"), ("X", "int")]}, {}, 1)
    with pytest.raises(ValueError):
        GraphSchema.declare("g", {"A": []}, {}, 0)
    with pytest.raises(ValueError):
        schema.vertex_type("C")


def test_reasons(spark):
    missing = [{k: v for k, v in GOOD.items() if k != gone} for gone in GOOD]
    bad_numbers = [{**GOOD, "graph.shard.number": "x"}, {**GOOD, "graph.replication.number": None}]
    reasons = [r.reason for r in parse(spark, GOOD, None, "oops", "[]", *missing, *bad_numbers).collect()]
    assert reasons == [
        None,
        None,
        "bad_json",
        "bad_json",
        "no_version",
        "no_name",
        "no_index_type",
        "no_replication_number",
        "no_shard_number",
        "no_vertex_tables",
        "no_edge_tables",
        "bad_shard_number",
        "bad_replication_number",
    ]


def test_round_trip(spark):
    full = {**GOOD, "graph.encryption.type": "SM4", "graph.index.separated": True}
    for doc, same in ((GOOD, {**GOOD, "graph.replication.number": 3}), (full, {**full, "graph.replication.number": 3})):
        parsed = parse(spark, doc)
        assert json.loads(parsed.select(schema_documents(parsed)).first()[0]) == same


def test_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "i int")
    assert [r[0] for r in df.select(label_column(F.col("i"), {1: "A"})).collect()] == ["A", None, None]
    assert [r[0] for r in df.select(label_column(F.col("i"), {})).collect()] == [None] * 3
    dictionary = spark.createDataFrame(
        [("vertex", 1, "A"), ("edge", 2, "E"), ("vertex", 1, "A2")], "kind string, label_index int, label_value string"
    )
    got = resolve_labels(df, "i", dictionary, "vertex")
    assert sorted((r.i, r.label) for r in got.where("i IS NOT NULL").collect()) == [(1, "A"), (2, None)]
    assert got.count() == 3


def test_profile(spark):
    graph = PropertyGraph(
        {
            "A": spark.createDataFrame([("1", 5, None), ("2", None, None)], "uid string, x int, never string"),
            "B": spark.createDataFrame([("1",)], "uid string"),
        },
        {
            "E": spark.createDataFrame(
                [("A", "1", "B", "1", ""), ("A", "2", "B", "1", ""), ("B", "1", "A", "1", "")],
                "src_label string, src_uid string, dst_label string, dst_uid string, euid string",
            )
        },
    )
    assert [tuple(r) for r in profile_vertices(graph).collect()] == [("A", "x", 1)]
    assert sorted(tuple(r) for r in profile_endpoints(graph).collect()) == [("E", "A", "B", 2), ("E", "B", "A", 1)]
    assert json.loads(schema_from_data(graph).first().value) == {
        "vertices": [{"label": "A", "fields": ["x"]}, {"label": "B", "fields": []}],
        "edges": [
            {"label": "E", "fields": [], "src_dst_labels": [{"src": "A", "dst": "B"}, {"src": "B", "dst": "A"}]}
        ],
    }


def test_labels_by_position_and_by_map(spark):
    df = spark.createDataFrame([(i,) for i in (-1, 0, 1, 5, 200, 60000, None)], "i int")
    near, far = {0: "z", 1: "A", 5: "B"}, {1: "A", 60000: "C"}
    for labels in (near, far):
        assert [r[0] for r in df.select(label_column(F.col("i"), labels)).collect()] == [labels.get(r.i) for r in df.collect()]


def test_dictionary_problems(spark):
    rows = [("vertex", 1, "A"), ("vertex", 1, "B"), ("edge", 1, "E"), ("vertex", 70000, "X"), ("vertex", None, "N")]
    found = dictionary_problems(spark.createDataFrame(rows, "kind string, label_index int, label_value string"))
    assert sorted((r.label_value, r.problem) for r in found.collect()) == [
        ("B", "index_taken"), ("N", "index_out_of_range"), ("X", "index_out_of_range")
    ]
