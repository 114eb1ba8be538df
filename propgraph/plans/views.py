"""Graph views: a named part of a graph, and its materialized form for the iterative algorithms.

A view is a pair of lazy tables. Materializing it numbers the vertices (64-bit ids instead of text) and adds up parallel
edges, and writes both as Parquet, so that every round of an algorithm shuffles small fixed-width rows only. A number is a hash
of the vertex' identity, so edges are numbered without a look-up; vertices that share a hash get other numbers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from propgraph.graph import ENDPOINT_COLUMNS, PropertyGraph
from propgraph.operators.match import Node, Rel, filter_uids, is_inline
from propgraph.operators.skew import ROWS_PER_TASK, spread_join
from propgraph.plans.pairs import EdgeBuckets, kept_pairs
from propgraph.session import delete_path, read_text, scratch_path, sized_partitions, write_once
from propgraph.storage import StoredGraph

SIDES = ("src", "dst")

#: Bits of a vertex' number that come from a hash; greater numbers are those of vertices that share theirs.
ID_BITS = 62

#: So many edges, of one source or of several, may be in one task of the shuffle that adds up parallel edges.
ROWS_PER_SOURCE = 1_000_000


@dataclass(frozen=True)
class GraphView:
    """``vertices``: ``label, uid``. ``edges``: ``label, src_label, src_uid, dst_label, dst_uid, euid``. ``fingerprint``
    names the graph, its version and the patterns; equal fingerprints mean equal views. ``buckets``: the edges of a stored
    graph by the buckets they are in."""

    vertices: DataFrame
    edges: DataFrame
    fingerprint: str
    buckets: EdgeBuckets | None = None

    def register(self, name: str) -> None:
        """Make the view known to SQL as ``<name>_vertices`` and ``<name>_edges``."""
        self.vertices.createOrReplaceTempView(f"{name}_vertices")
        self.edges.createOrReplaceTempView(f"{name}_edges")


def graph_view(
    graph: PropertyGraph,
    vertex_patterns: Sequence[Node] = (),
    edge_patterns: Sequence[Rel] = (),
    version: str | None = None,
) -> GraphView:
    """The subgraph of all vertices and edges that fit one of the patterns (all of them if none is given).

    ``version`` names the data for reuse; a stored graph knows its own. Without one the view is never reused.
    """
    vertex_patterns = vertex_patterns or [Node("a", label) for label in graph.vertex_tables]
    edge_patterns = edge_patterns or [Rel("b", label) for label in graph.edge_tables]
    vertices = [
        _pattern_vertices(table, label, [n for n in vertex_patterns if n.label in (None, label)])
        for label, table in graph.vertex_tables.items()
        if any(n.label in (None, label) for n in vertex_patterns)
    ]
    edges = [
        _pattern_edges(table, label, [r for r in edge_patterns if r.label in (None, label)])
        for label, table in graph.edge_tables.items()
        if any(r.label in (None, label) for r in edge_patterns)
    ]
    if not edges:
        raise ValueError("a view needs at least one edge label")
    unknown = {n.label for n in vertex_patterns} - {None, *graph.vertex_tables}
    unknown |= {r.label for r in edge_patterns} - {None, *graph.edge_tables}
    if unknown:
        raise ValueError(f"no label {', '.join(sorted(unknown))}")
    if version is None and hasattr(graph, "fingerprint"):
        version = graph.fingerprint()
    lists = all(n.uids is None or not isinstance(n.uids, DataFrame) for n in vertex_patterns)
    fingerprint = ""
    if version is not None and lists:
        patterns = [(n.label, n.uids, str(n.where)) for n in vertex_patterns]
        patterns += [(r.label, str(r.where)) for r in edge_patterns]
        fingerprint = hashlib.sha256(repr((version, patterns)).encode()).hexdigest()
    return GraphView(
        reduce(DataFrame.unionByName, vertices),
        reduce(DataFrame.unionByName, edges),
        fingerprint,
        _edge_buckets(graph, edge_patterns) if isinstance(graph, StoredGraph) else None,
    )


def _edge_buckets(graph: StoredGraph, patterns: Sequence[Rel]) -> EdgeBuckets:
    select = {
        label: partial(_pattern_edges, label=label, patterns=[r for r in patterns if r.label in (None, label)])
        for label in graph.edge_tables
        if any(r.label in (None, label) for r in patterns)
    }
    text = repr((graph.root, sorted((r.label or "", str(r.where)) for r in patterns)))
    return EdgeBuckets(graph, select, hashlib.sha256(text.encode()).hexdigest())


def _any_of(patterns: Sequence[Node | Rel]) -> Column | None:
    """One condition for all patterns of a label, so that a row that fits several of them is there once; None if one of
    the patterns takes all rows."""
    conditions = []
    for p in patterns:
        parts = [] if p.where is None else [F.expr(p.where) if isinstance(p.where, str) else p.where]
        if isinstance(p, Node) and p.uids is not None:
            parts.append(F.col("uid").isin([str(u) for u in p.uids]))
        if not parts:
            return None
        conditions.append(F.coalesce(reduce(Column.__and__, parts), F.lit(False)))
    return reduce(Column.__or__, conditions)


def _pattern_vertices(table: DataFrame, label: str, patterns: Sequence[Node]) -> DataFrame:
    """Vertices of one label. Patterns with a table of ids are semi-joined, the others are one filter."""
    by_table = [n for n in patterns if not is_inline(n.uids)]
    others = [n for n in patterns if is_inline(n.uids)]
    parts = [filter_uids(_labelled(table if n.where is None else table.where(n.where), label), n.uids) for n in by_table]
    if others:
        condition = _any_of(others)
        parts.append(_labelled(table if condition is None else table.where(condition), label))
    union = reduce(DataFrame.unionByName, parts)
    return union if len(parts) == 1 else union.distinct()


def _labelled(table: DataFrame, label: str) -> DataFrame:
    return table.select(F.lit(label).alias("label"), "uid")


def _pattern_edges(table: DataFrame, label: str, patterns: Sequence[Rel]) -> DataFrame:
    condition = _any_of(patterns)
    kept = table if condition is None else table.where(condition)
    return kept.select(F.lit(label).alias("label"), "src_label", "src_uid", "dst_label", "dst_uid", "euid")


@dataclass(frozen=True)
class MaterializedView:
    """``vertices``: ``id, label, uid``. ``edges``: ``src, dst, w`` with unique (src, dst) and the number of parallel
    edges as weight."""

    vertices: DataFrame
    edges: DataFrame
    path: str


def materialize(
    spark: SparkSession, view: GraphView, path: str | None = None, reuse: bool = True, rows_per_task: int = ROWS_PER_TASK
) -> MaterializedView:
    """Write the view below ``path``, or read it back if it is there and ``reuse`` is set.

    The fingerprint is part of the folder, so a view of other data or other patterns below the same path is never taken by
    mistake. Every build has a folder of its own; the first that is complete is named in one file, written last, and is the one
    that is reused. A build that dies leaves a folder nobody reads. Edges count only if both endpoints are vertices of the
    view.
    """
    marker = pairs = None
    if path is None or not view.fingerprint:
        folder = scratch_path(spark, "view") if path is None else scratch_path(spark, "view-of-unnamed-data")
    else:
        root = f"{path.rstrip('/')}/{view.fingerprint}"
        marker = f"{root}/ready"
        ready = read_text(spark, marker) if reuse else None
        folder = f"{root}/{ready or uuid.uuid4().hex}"
        if ready:
            return _read_view(spark, folder)
        if reuse and view.buckets:
            pairs = kept_pairs(spark, f"{path.rstrip('/')}/pairs/{view.buckets.name}", view.buckets)
    edges = view.edges.select(*ENDPOINT_COLUMNS, F.lit(1).cast("bigint").alias("w")) if pairs is None else pairs
    shared = _write_vertices(spark, view.vertices, f"{folder}/vertices")
    vertices = spark.read.schema("id bigint, label string, uid string").parquet(f"{folder}/vertices")
    numbered = _number_edges(spark, edges, vertices, shared, rows_per_task)
    numbered.write.option("compression", "zstd").parquet(f"{folder}/edges")
    if marker:
        write_once(spark, marker, folder.rsplit("/", 1)[1])
    return _read_view(spark, folder)


def _read_view(spark: SparkSession, folder: str) -> MaterializedView:
    return MaterializedView(
        spark.read.schema("id bigint, label string, uid string").parquet(f"{folder}/vertices"),
        spark.read.schema("src bigint, dst bigint, w bigint").parquet(f"{folder}/edges"),
        folder,
    )


def _number(label: str, uid: str) -> Column:
    """A vertex' number, a hash of its identity; below ``1 << ID_BITS``."""
    return F.shiftrightunsigned(F.xxhash64(label, uid), 64 - ID_BITS)


def _write_vertices(spark: SparkSession, vertices: DataFrame, path: str) -> bool:
    """Write ``id, label, uid``, each row with an id of its own; whether some ids are not the hash of label and uid.

    These are the ids of rows that have their hash in common with others, be it by chance or as copies of one vertex. They are
    counted up from ``1 << ID_BITS``.
    """
    hashed = vertices.select(_number("label", "uid").alias("id"), "label", "uid")
    hashed.write.parquet(path)
    hashed = spark.read.schema(hashed.schema).parquet(path)
    shared_path, written = scratch_path(spark, "shared-numbers"), Observation()
    shared = hashed.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    shared.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(shared_path)
    if written.get["n"]:
        shared = spark.read.schema(shared.schema).parquet(shared_path)
        counted = (F.monotonically_increasing_id() + F.lit(1 << ID_BITS)).alias("id")
        others = hashed.join(shared, "id", "left_semi").select(counted, "label", "uid")
        whole_path = scratch_path(spark, "numbers")
        hashed.join(shared, "id", "left_anti").unionByName(others).write.parquet(whole_path)
        delete_path(spark, path)
        spark.read.schema(hashed.schema).parquet(whole_path).write.parquet(path)
        delete_path(spark, whole_path)
    delete_path(spark, shared_path)
    return bool(written.get["n"])


def _ends(edges: DataFrame) -> DataFrame:
    """``label, uid`` of the endpoints of edges and the number ``n`` of rows that have one as source. Both ends are counted in one
    pass, which combines on the map side, so hubs are single rows afterwards."""
    ends = (F.struct(F.col(f"{s}_label").alias("label"), F.col(f"{s}_uid").alias("uid"), F.lit(int(s == "src")).alias("n")) for s in SIDES)
    return edges.select(F.explode(F.array(*ends)).alias("end")).groupBy("end.label", "end.uid").agg(F.sum("end.n").alias("n"))


def _number_edges(spark: SparkSession, edges: DataFrame, vertices: DataFrame, shared: bool, rows_per_task: int) -> DataFrame:
    """``src, dst`` and the sum of ``w`` over the edges between them, of edges whose endpoints are vertices.

    Numbers are computed where an edge is read, so that one shuffle of numbers adds up parallel edges. Edges meet a table only
    for endpoints that are missing, or have a number that is not their hash; either table is joined if it has rows. If no source has
    more than ``ROWS_PER_SOURCE`` edges, they are shuffled and sorted by source: neighbours then take less room, here and in
    shuffles of those who read them. Else by both ends, combined on the map side.
    """
    edges = edges.where(reduce(Column.__and__, (F.col(c).isNotNull() for c in ENDPOINT_COLUMNS)))
    path, written, counted_ends = scratch_path(spark, "missing-ends"), Observation(), Observation()
    ends = _ends(edges).observe(counted_ends, F.max("n").alias("most"), F.sum("n").alias("edges"))
    missing = ends.select("label", "uid").join(vertices.select("label", "uid"), ["label", "uid"], "left_anti")
    missing.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if written.get["n"]:
        missing = spark.read.schema(missing.schema).parquet(path)
        for side in SIDES:
            keys = [f"{side}_label", f"{side}_uid"]
            edges = edges.join(missing.toDF(*keys), keys, "left_anti")
    numbers = {side: _number(f"{side}_label", f"{side}_uid") for side in SIDES}
    if shared:
        counted = vertices.where(F.col("id") >= F.lit(1 << ID_BITS))
        for side in SIDES:
            keys = [f"{side}_label", f"{side}_uid"]
            ids = counted.select(F.col("label").alias(keys[0]), F.col("uid").alias(keys[1]), F.col("id").alias(side))
            edges = spread_join(edges, ids, keys, "left", rows_per_task)
            numbers[side] = F.coalesce(F.col(side), numbers[side])
    numbered, total = edges.select(*(c.alias(side) for side, c in numbers.items()), "w"), F.sum("w").alias("w")
    if (counted_ends.get["most"] or 0) > ROWS_PER_SOURCE:
        return numbered.groupBy(*SIDES).agg(total)
    partitions = sized_partitions(spark, counted_ends.get["edges"] or 0, most_per_partition=ROWS_PER_SOURCE)
    return numbered.repartition(partitions, "src").groupBy(*SIDES).agg(total).sortWithinPartitions("src")
