"""Vertex numbers of stored graphs."""

from __future__ import annotations

import re

import pytest

from propgraph.functions import keys as K
from propgraph.operators.elements import keys_to_uids
from propgraph.operators.load import load_vertices
from propgraph.plans.numbers import VertexNumbers, number_vertices, uids_to_keys
from propgraph.session import scratch_path
from propgraph.storage import StoredGraph

MAPPING = [("__uid", "uid"), ("name", "name")]


def people(spark, ids):
    return spark.createDataFrame([(i, "n") for i in ids], "uid string, name string")


@pytest.fixture
def graph(spark):
    labels = {"Person": [("name", "string")], "Town": [("name", "string")]}
    return StoredGraph.create(spark, scratch_path(spark, "graph"), "g", labels, {"knows": []}, shards=8)


def numbers_of(numbers: VertexNumbers) -> dict:
    return {(r.label, r.uid): r.number for r in numbers.table().collect()}


@pytest.mark.parametrize("rows_per_task", [1, 3, 1_000_000])
def test_numbers_stay_and_have_no_gaps(spark, graph, rows_per_task):
    path = scratch_path(spark, "numbers")
    assert numbers_of(number_vertices(graph, path)) == {}
    graph = load_vertices(graph, people(spark, [str(i) for i in range(50)] + ["", "ä"]), "Person", MAPPING).graph
    first = numbers_of(number_vertices(graph, path, rows_per_task))
    graph = load_vertices(graph, people(spark, [str(i) for i in range(40, 90)]), "Person", MAPPING).graph
    graph = load_vertices(graph, people(spark, ["1", "2"]), "Town", MAPPING).graph
    numbers = number_vertices(graph, path, rows_per_task)
    second = numbers_of(numbers)
    assert len(set(second.values())) == len(second) == 94 and first.items() <= second.items() and len(first) == 52
    shards: dict = {}
    for r in numbers.table().collect():
        shards.setdefault((r.label, r.shard), []).append(r.inner)
    assert all(sorted(inner) == list(range(len(inner))) for inner in shards.values())
    assert numbers_of(VertexNumbers.open(spark, path)) == second
    again = number_vertices(graph, path)
    assert again.generation == numbers.generation and numbers_of(again) == second


def test_only_loaded_buckets_are_read(spark, graph, monkeypatch):
    graph = load_vertices(graph, people(spark, map(str, range(200))), "Person", MAPPING).graph
    path = scratch_path(spark, "numbers")
    number_vertices(graph, path)
    graph = load_vertices(graph, people(spark, ["new"]), "Person", MAPPING).graph
    read = []
    buckets = StoredGraph.buckets
    monkeypatch.setattr(StoredGraph, "buckets", lambda self, kind, label, names: read.append(list(names)) or buckets(self, kind, label, names))
    numbers = number_vertices(graph, path)
    assert [len(names) for names in read] == [1]
    assert numbers.table().count() == 201
    plan = numbers.entries().where("label_index = 1 AND __bucket = 3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*__bucket", plan)


def test_the_second_of_two_extensions_fails(spark, graph, monkeypatch):
    graph = load_vertices(graph, people(spark, "abc"), "Person", MAPPING).graph
    path = scratch_path(spark, "numbers")
    empty = VertexNumbers.open(spark, path)
    number_vertices(graph, path)
    monkeypatch.setattr(VertexNumbers, "open", lambda spark, path: empty)
    with pytest.raises(ValueError, match="number the vertices again"):
        number_vertices(graph, path)


def test_keys_there_and_back(spark, graph):
    graph = load_vertices(graph, people(spark, "abc"), "Person", MAPPING).graph
    graph = load_vertices(graph, people(spark, "ab"), "Town", MAPPING).graph
    numbers = number_vertices(graph, scratch_path(spark, "numbers"))
    pairs = [("Person", "a"), ("Person", "a"), ("Town", "a"), ("Town", "c"), (None, "a"), ("Person", None)]
    rows = uids_to_keys(spark.createDataFrame(pairs, "l string, u string"), "l", "u", numbers, "rk", rows_per_task=1)
    got = keys_to_uids(rows, "rk", numbers.table(), "back", rows_per_task=1).collect()
    want = [(label, u, u if (label, u) in {("Person", "a"), ("Town", "a")} else None) for label, u in pairs]
    assert sorted(((r.l, r.u, r.back) for r in got), key=str) == sorted(want, key=str)
    table = numbers.table().selectExpr("*", "cast(split(rk, ' ') AS array<int>) AS key")
    parts = table.select("shard", "label_index", "inner", "number", K.shard_id(table.key), K.label_index(table.key), K.inner_id(table.key), K.pack_key(table.key))
    assert all(tuple(r)[:4] == tuple(r)[4:] for r in parts.collect()) and parts.count() == 5
