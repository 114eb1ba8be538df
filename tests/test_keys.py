from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propgraph.functions import keys as K


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_known_packed_key(spark):
    k = F.col("k")
    rows = one(
        spark,
        [([-1, -15, 2, 0, 0, 0, 1, -1],)],
        "k array<int>",
        K.shard_id(k),
        K.label_index(k),
        K.inner_id(k),
        K.key_text(k),
    )
    assert rows == [(4095, 258, 511, "-1 -15 2 0 0 0 1 -1")]


def test_known_legacy_key(spark):
    k = F.col("k")
    rows = one(spark, [([97, -61, -87, 5, 0],)], "k array<int>", K.legacy_uid(k), K.legacy_label_index(k))
    assert rows == [("aé", 5)]


def test_legacy_label_bytes_are_unsigned(spark):
    rows = one(spark, [([97, -1, -128],)], "k array<int>", K.legacy_label_index(F.col("k")))
    assert rows == [(0x80FF,)]


@pytest.mark.parametrize("key", [None, [], [1], [-1, -1]])
def test_short_keys_are_null_not_errors(spark, key):
    k = F.col("k")
    ((shard, label, inner),) = one(spark, [(key,)], "k array<int>", K.shard_id(k), K.label_index(k), K.inner_id(k))
    assert label is None and inner is None
    assert shard is None or len(key) == 2


def test_bad_utf8_is_null(spark):
    rows = one(spark, [([-1, -2, 1, 0],)], "k array<int>", K.legacy_uid(F.col("k")), K.legacy_label_index(F.col("k")))
    assert rows == [(None, 1)]


def test_empty_legacy_uid(spark):
    key = K.legacy_vertex_key(F.col("u"), F.lit(7))
    assert one(spark, [("",)], "u string", key) == [([7, 0],)]
    assert one(spark, [([7, 0],)], "k array<int>", K.legacy_uid(F.col("k"))) == [("",)]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 4095), st.integers(0, 4095), st.integers(0, 2**40 - 1)), min_size=1, max_size=50
    )
)
def test_packed_round_trip(spark, keys):
    df = spark.createDataFrame(keys, "s bigint, l bigint, i bigint")
    df = df.withColumn("k", K.vertex_key(F.col("s"), F.col("l"), F.col("i")))
    k = F.col("k")
    got = df.select(K.shard_id(k), K.label_index(k), K.inner_id(k)).collect()
    assert [tuple(r) for r in got] == keys
    again = df.select((K.pack_key(K.unpack_key(K.pack_key(k))) == K.pack_key(k)).alias("same"), F.size(k).alias("n"))
    assert {tuple(r) for r in again.collect()} == {(True, 8)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), st.integers(0, 65535)), min_size=1, max_size=30))
def test_legacy_round_trip(spark, keys):
    df = spark.createDataFrame(keys, "u string, l int").withColumn("k", K.legacy_vertex_key(F.col("u"), F.col("l")))
    got = df.select(K.legacy_uid(F.col("k")), K.legacy_label_index(F.col("k"))).collect()
    assert [tuple(r) for r in got] == keys


def test_edge_key(spark):
    k = F.col("k")
    key = list(range(1, 9)) + list(range(-8, 0)) + [99]
    rows = one(spark, [(key,)], "k array<int>", K.start_key(k), K.end_key(k), K.inner_id(k, 8))
    assert rows == [(key[:8], key[8:16], int.from_bytes(bytes(b & 255 for b in key[11:16]), "big"))]
