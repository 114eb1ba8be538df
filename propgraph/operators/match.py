"""Pattern match as joins.

A pattern is a chain ``Node, Rel, Node, Rel, Node, ...`` read as directed edges from left to right. The result has one row
per way to place the chain on stored edges (bag semantics); an edge with an absent endpoint does not match, and an edge is
used at most once within one match. Columns are flat and prefixed by the pattern's variables (``a_uid``, ``f_euid``,
``a_<property>``), so that only columns in use reach the scans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from propgraph.functions.properties import pack_properties
from propgraph.graph import EDGE_KEY_COLUMNS, TAGS, PropertyGraph, identity_text
from propgraph.operators.skew import BROADCAST_KEYS, ROWS_PER_TASK, heavy_keys, spread_join
from propgraph.session import scratch_path

# Longer id lists are joined as a table instead of being written into the filter.
MAX_INLINE_IDS = 1000


@dataclass(frozen=True, eq=False)
class Node:
    """A vertex of the pattern. ``uids`` is a list or a table with a ``uid`` (and optionally ``label``) column; ``where``
    is a condition on the vertex' own columns, which needs a label to name properties. Without ``properties`` a match has its
    label and uid only."""

    var: str
    label: str | None = None
    uids: Sequence[str] | DataFrame | None = None
    where: str | Column | None = None
    properties: bool = True


@dataclass(frozen=True, eq=False)
class Rel:
    """A directed edge of the pattern."""

    var: str
    label: str | None = None
    where: str | Column | None = None


def match_vertices(graph: PropertyGraph, node: Node) -> DataFrame:
    """Vertices of one pattern node, columns ``label, uid`` and the properties (typed if the node has a label, else one
    ``properties`` map). A uid predicate without label holds for that uid under every label."""
    if node.label is None:
        df = graph.vertices().select("label", "uid", "properties")
    else:
        table = graph.vertex_rows(node.label, node.uids if node.uids is not None and is_inline(node.uids) else None)
        properties = [_own(c) for c in graph.vertex_properties(node.label)]
        df = table.select(F.lit(node.label).alias("label"), "uid", *properties, *graph.tag_columns("vertex", node.label))
    if node.where is not None:
        df = df.where(node.where)
    df = df if node.uids is None else filter_uids(df, node.uids)
    return df if node.properties else df.select("label", "uid")


def _own(name: str) -> Column:
    """A property's column; one named ``label`` comes as ``label_property``, since that name is the element's label."""
    return F.col(f"`{name}`").alias("label_property" if name.lower() == "label" else name)


def filter_uids(df: DataFrame, uids: Sequence[str] | DataFrame) -> DataFrame:
    """Keep rows whose uid is in a list or in a table of ids (with or without label).

    A table is semi-joined; whether its side is broadcast is left to Spark's size check. Its ids are made distinct first,
    which combines on the map side: an id that repeats very often would else be one task of the join.
    """
    if isinstance(uids, DataFrame):
        keys = [c for c in ("label", "uid") if c in uids.columns]
        return df.join(uids.select(*keys).distinct(), keys, "left_semi").select(*df.columns)
    if is_inline(uids):
        return df.where(F.col("uid").isin([str(u) for u in uids]))
    ids = df.sparkSession.createDataFrame([(str(u),) for u in uids], "uid string")
    return df.join(ids, ["uid"], "left_semi").select(*df.columns)


def is_inline(uids: Sequence[str] | DataFrame | None) -> bool:
    """Whether an id predicate (or none) is written into a filter."""
    return uids is None or (not isinstance(uids, DataFrame) and len(uids) <= MAX_INLINE_IDS)


def match(
    graph: PropertyGraph, *pattern: Node | Rel, spread_hubs: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Match a chain of nodes and edges.

    The joins start at the node with the most selective predicate. With ``spread_hubs`` the edges of hub vertices are cut
    of at most about ``rows_per_task`` edges before they are joined; hubs are counted on the edge tables, once per edge of the
    pattern and end. Otherwise adaptive execution splits skewed partitions where it meets them.

    If no node has a predicate, edges do not move to the vertices of nodes without properties: see ``_odd_ends``.
    """
    nodes, rels = _check(pattern)
    spread = rows_per_task if spread_hubs else None
    anchor = _anchor(nodes)
    odd = {} if spread_hubs else _odd_ends(graph, nodes, rels, anchor)
    rows = None if nodes[anchor] in odd else _node_rows(graph, nodes[anchor])
    for i in range(anchor, len(rels)):
        rows = _expand(graph, rows, nodes[i], rels[i], nodes[i + 1], forward=True, spread=spread, odd=odd)
    for i in range(anchor - 1, -1, -1):
        rows = _expand(graph, rows, nodes[i + 1], rels[i], nodes[i], forward=False, spread=spread, odd=odd)
    for i, left in enumerate(rels):
        for right in rels[i + 1 :]:
            if left.label is None or right.label is None or left.label == right.label:
                rows = rows.where(~_same_edge(left.var, right.var))
    return rows.select(*(c for part in pattern for c in rows.columns if c.startswith(f"{part.var}_")))


def count_matches(graph: PropertyGraph, *pattern: Node | Rel, spread_hubs: bool = False) -> DataFrame:
    """How many matches start at each vertex of the first node: ``label, uid, n``.

    The chain is counted from its end, one number per vertex and hop, so the matches themselves, which multiply at every
    vertex with many edges in and out, are never listed. The edges need different labels: the count cannot tell whether a
    match uses one edge twice.

    The numbers of a hop are written before the next one joins edges with them: the join then has shuffles of its own, of which
    adaptive execution splits the parts that hubs make large. Over numbers that come from a join on the same key it could not.
    """
    nodes, rels = _check(pattern)
    labels = [r.label for r in rels]
    if None in labels or len(set(labels)) < len(labels):
        raise ValueError("count_matches needs a different label on every edge")
    keys = ["label", "uid"]
    counts = match_vertices(graph, nodes[-1]).select(*keys, F.lit(1).cast("bigint").alias("n"))
    for src, rel, dst in reversed(list(zip(nodes, rels, nodes[1:]))):
        edges = _edge_rows(graph, rel, src, dst).select(
            *(F.col(f"{rel.var}_{side}_{k}").alias(f"{side}_{k}") for side in ("src", "dst") for k in keys)
        )
        ends = counts.withColumnsRenamed({k: f"dst_{k}" for k in keys})
        dst_keys = [f"dst_{k}" for k in keys]
        joined = spread_join(edges, ends, dst_keys) if spread_hubs else edges.join(ends, dst_keys)
        onward = joined.groupBy(*(F.col(f"src_{k}").alias(k) for k in keys)).agg(F.sum("n").alias("n"))
        counts = match_vertices(graph, src).select(*keys).join(onward, keys)
        if src is not nodes[0]:
            path = scratch_path(counts.sparkSession, "counts")
            counts.write.parquet(path)
            counts = counts.sparkSession.read.schema(counts.schema).parquet(path)
    return counts


def _check(pattern: Sequence[Node | Rel]) -> tuple[list[Node], list[Rel]]:
    nodes, rels = list(pattern[::2]), list(pattern[1::2])
    if len(pattern) % 2 == 0 or not all(isinstance(n, Node) for n in nodes) or not all(isinstance(r, Rel) for r in rels):
        raise ValueError("a pattern is a chain of Node, Rel, Node, ...")
    names = [part.var for part in pattern]
    if len(set(names)) < len(names) or any("_" in name for name in names):
        raise ValueError("pattern variables must be distinct and free of underscores")
    return nodes, rels


def _anchor(nodes: Sequence[Node]) -> int:
    def selectivity(i: int) -> tuple:
        node = nodes[i]
        return (node.uids is None, node.where is None, node.label is None, i)

    return min(range(len(nodes)), key=selectivity)


def _prefixed(df: DataFrame, var: str) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(f"{var}_{c}") for c in df.columns))


def _node_rows(graph: PropertyGraph, node: Node) -> DataFrame:
    return _prefixed(match_vertices(graph, node), node.var)


def _edge_rows(graph: PropertyGraph, rel: Rel, src: Node, dst: Node, table: DataFrame | None = None) -> DataFrame:
    """The edges of a pattern's edge, of all its table or of a part of it."""
    if rel.label is None:
        df = graph.edges().select(
            "label",
            F.col("src.label").alias("src_label"),
            F.col("src.uid").alias("src_uid"),
            F.col("dst.label").alias("dst_label"),
            F.col("dst.uid").alias("dst_uid"),
            "euid",
            "properties",
        )
    else:
        table = graph.edge_tables[rel.label] if table is None else table
        properties = [_own(c) for c in graph.edge_properties(rel.label)]
        tags = graph.tag_columns("edge", rel.label)
        df = table.select(F.lit(rel.label).alias("label"), *EDGE_KEY_COLUMNS, *properties, *tags)
    if src.label is not None:
        df = df.where(F.col("src_label") == src.label)
    if dst.label is not None:
        df = df.where(F.col("dst_label") == dst.label)
    if rel.where is not None:
        df = df.where(rel.where)
    return _prefixed(df, rel.var)


def _expand(
    graph: PropertyGraph, rows: DataFrame | None, at: Node, rel: Rel, to: Node, forward: bool, spread: int | None,
    odd: dict[Node, DataFrame | None],
) -> DataFrame:
    """Extend the rows from the bound node ``at`` over one edge to the node ``to``. Without rows the edges are the first."""
    near, far = ("src", "dst") if forward else ("dst", "src")
    src, dst = (at, to) if forward else (to, at)
    edges = _edge_rows(graph, rel, src, dst)
    if rows is None:
        rows = _check_end(edges, f"{rel.var}_{near}", at, odd[at])
    elif spread is None:
        parts = (_edge_rows(graph, rel, src, dst, table) for table in graph.edge_parts(rel.label, near))
        rows = reduce(DataFrame.unionByName, [_join_endpoint(part, rows, part, f"{rel.var}_{near}", at, None) for part in parts])
    else:
        rows = _join_endpoint(edges, rows, edges, f"{rel.var}_{near}", at, spread)
    if to in odd:
        return _check_end(rows, f"{rel.var}_{far}", to, odd[to])
    if graph.whole and to.label is not None and not to.properties and to.where is None and to.uids is None:
        # The end is known to exist, and the edge has all of it that is wanted.
        return rows.select("*", *(F.col(f"{rel.var}_{far}_{p}").alias(f"{to.var}_{p}") for p in ("label", "uid")))
    return _join_endpoint(rows, _node_rows(graph, to), edges, f"{rel.var}_{far}", to, spread)


def _odd_ends(graph: PropertyGraph, nodes: Sequence[Node], rels: Sequence[Rel], anchor: int) -> dict[Node, DataFrame | None]:
    """For nodes of which only label and uid are wanted: the endpoints of edges that are not exactly one vertex, and how many they
    are; None if there is no such endpoint.

    All other edges match as they are. Vertices and endpoints are added up in one shuffle, in which they combine on the map
    side; nodes with the same label share it. Of a pattern with a predicate few edges may be wanted, so it is matched by joins.
    """
    if graph.whole or not rels or any(n.uids is not None or n.where is not None for n in nodes):
        return {}
    ends: dict[str | None, list] = {}
    for i, node in enumerate(nodes):
        side = "dst" if i > anchor or (i == anchor and anchor == len(rels)) else "src"
        src = i - 1 if side == "dst" else i
        if node.properties:
            continue
        edges = _edge_rows(graph, rels[src], nodes[src], nodes[src + 1])
        end = edges.select(*(F.col(f"{rels[src].var}_{side}_{k}").alias(k) for k in ("label", "uid")))
        if end.schema["uid"].dataType == match_vertices(graph, node).schema["uid"].dataType:
            ends.setdefault(node.label, []).append((node, end))
    found = {}
    for label, own in ends.items():
        vertices = match_vertices(graph, own[0][0]).select("label", "uid", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("end"))
        used = reduce(DataFrame.unionByName, [e.select("label", "uid", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("end")) for _, e in own])
        counts = vertices.unionByName(used).where("label IS NOT NULL AND uid IS NOT NULL").groupBy("label", "uid")
        odd = counts.agg(F.sum("n").alias("n"), F.max("end").alias("end")).where("end AND n <> 1").select("label", "uid", "n")
        spark, written = odd.sparkSession, Observation()
        path = scratch_path(spark, "odd-ends")
        odd.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
        stored = spark.read.schema(odd.schema).parquet(path)
        rows = written.get["n"] or 0
        stored = None if not rows else F.broadcast(stored) if rows <= BROADCAST_KEYS else stored
        found |= {node: stored for node, _ in own}
    return found


def _check_end(rows: DataFrame, endpoint: str, node: Node, odd: DataFrame | None) -> DataFrame:
    """The rows once per vertex at their endpoint, with label and uid of the node, as a join with its vertices would give them."""
    keys = [f"{endpoint}_label", f"{endpoint}_uid"]
    columns = [F.col(key).alias(f"{node.var}_{p}") for key, p in zip(keys, ("label", "uid"), strict=True)]
    rows = rows.where(reduce(Column.__and__, (F.col(key).isNotNull() for key in keys)))
    if odd is not None:
        times = F.coalesce(F.col("__n"), F.lit(1)).cast("int")
        joined = rows.join(odd.toDF(*keys, "__n"), keys, "left").withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times)))
        rows = joined.select(*rows.columns)
    return rows.select("*", *columns)


def _join_endpoint(
    many: DataFrame, other: DataFrame, edges: DataFrame, endpoint: str, node: Node, spread: int | None
) -> DataFrame:
    """Join ``many`` rows at their edge endpoint with the rows of the vertex; a fixed label needs no join column.

    Hubs are those of ``edges``, not of ``many``, which may be a join that would have to run for the count.
    """
    parts = ["uid"] if node.label is not None else ["label", "uid"]
    if spread is not None:
        keys = [f"{endpoint}_{p}" for p in parts]
        renamed = reduce(lambda df, p: df.withColumn(f"{endpoint}_{p}", F.col(f"{node.var}_{p}")), parts, other)
        return spread_join(many, renamed, keys, heavy=heavy_keys(edges, keys, spread))
    condition = reduce(Column.__and__, (F.col(f"{endpoint}_{p}") == F.col(f"{node.var}_{p}") for p in parts))
    return many.join(other, condition)


def _same_edge(left: str, right: str) -> Column:
    return reduce(
        Column.__and__, (F.col(f"{left}_{c}") == F.col(f"{right}_{c}") for c in ("label", *EDGE_KEY_COLUMNS))
    )


# --- values built from a match --------------------------------------------------------------------------------------


def _bound_properties(rows: DataFrame, part: Node | Rel, identity: Sequence[str], wanted: bool) -> Column:
    """The properties that a match has of one element, as a map; an empty one if they are not wanted."""
    if not wanted or (isinstance(part, Node) and not part.properties):
        return pack_properties({})
    if part.label is None:
        return F.col(f"{part.var}_properties")
    prefix = f"{part.var}_"
    names = [c.removeprefix(prefix) for c in rows.columns if c.startswith(prefix)]
    own = [n for n in names if n not in identity and n != TAGS]
    return pack_properties({"label" if n == "label_property" else n: F.col(f"`{prefix}{n}`") for n in own})


def _bound_tags(rows: DataFrame, var: str) -> Column:
    tags = dict(rows.dtypes).get(f"{var}_{TAGS}")
    empty = F.array().cast("array<string>")
    return F.coalesce(F.col(f"{var}_{TAGS}"), empty) if tags == "array<string>" else empty


def vertex_value(rows: DataFrame, node: Node, properties: bool = True) -> Column:
    """A matched node as an element: ``label, uid, tags, properties, rk``."""
    var = node.var
    return F.struct(
        F.col(f"{var}_label").alias("label"),
        F.col(f"{var}_uid").alias("uid"),
        _bound_tags(rows, var).alias("tags"),
        _bound_properties(rows, node, ["label", "uid"], properties).alias("properties"),
        identity_text(f"{var}_label", f"{var}_uid").alias("rk"),
    )


def edge_value(rows: DataFrame, rel: Rel, properties: bool = True) -> Column:
    """A matched edge as an element: ``label, euid, src, dst, tags, properties, rk``."""
    var = rel.var
    ends = [
        F.struct(
            F.col(f"{var}_{side}_label").alias("label"),
            F.col(f"{var}_{side}_uid").alias("uid"),
            identity_text(f"{var}_{side}_label", f"{var}_{side}_uid").alias("rk"),
        ).alias(side)
        for side in ("src", "dst")
    ]
    key = [f"{var}_{c}" for c in ("label", *EDGE_KEY_COLUMNS)]
    return F.struct(
        F.col(f"{var}_label").alias("label"),
        F.col(f"{var}_euid").alias("euid"),
        *ends,
        _bound_tags(rows, var).alias("tags"),
        _bound_properties(rows, rel, ["label", *EDGE_KEY_COLUMNS], properties).alias("properties"),
        identity_text(*key).alias("rk"),
    )


def bind_path(
    rows: DataFrame, pattern: Sequence[Node | Rel], name: str = "path", properties: bool | Sequence[str] = True
) -> DataFrame:
    """Add the matched chain as an array of ``pos, kind, vertex, edge``, as paths are decoded: even position vertex, odd
    position edge, each with its tags and properties.

    ``properties`` says of which variables the properties are wanted: of all, of none, or of those named. Elements of the
    others have an empty map, and their properties are neither read nor carried through the joins.
    """
    wanted = {p.var: properties if isinstance(properties, bool) else p.var in properties for p in pattern}
    nodes = {p.var: vertex_value(rows, p, wanted[p.var]) for p in pattern if isinstance(p, Node)}
    rels = {p.var: edge_value(rows, p, wanted[p.var]) for p in pattern if isinstance(p, Rel)}
    probe = rows.select(*(c.alias(v) for v, c in (nodes | rels).items())).schema
    vertex_type, edge_type = probe[pattern[0].var].dataType, probe[pattern[1].var].dataType if rels else None
    elements = []
    for i, p in enumerate(pattern):
        edge = [F.lit(None).cast(edge_type).alias("edge")] if edge_type else []
        if isinstance(p, Node):
            element = [F.lit("vertex").alias("kind"), nodes[p.var].alias("vertex"), *edge]
        else:
            element = [F.lit("edge").alias("kind"), F.lit(None).cast(vertex_type).alias("vertex"), rels[p.var].alias("edge")]
        elements.append(F.struct(F.lit(i).alias("pos"), *element))
    return rows.withColumn(name, F.array(*elements))


def distinct_matches(rows: DataFrame, pattern: Sequence[Node | Rel]) -> DataFrame:
    """The distinct chains of a match: their identity columns, once each. An edge's endpoints are its neighbors in the
    chain, so label and edge id complete its identity. Labels that the pattern names are the same in all rows and are not compared."""
    ids = [(p, c) for p in pattern for c in (f"{p.var}_label", f"{p.var}_uid" if isinstance(p, Node) else f"{p.var}_euid")]
    named = {c: p.label for p, c in ids if c.endswith("_label") and p.label is not None}
    distinct = rows.select(*(c for _, c in ids if c not in named)).distinct()
    return distinct.select(*(F.lit(named[c]).alias(c) if c in named else F.col(c) for _, c in ids))


def top_k(df: DataFrame, order: Sequence[Column], k: int | str | None = None) -> DataFrame:
    """Sort, and keep the first ``k`` rows if given (an int or its text)."""
    k = check_limit(k)
    return df.orderBy(*order) if k is None else df.orderBy(*order).limit(k)


def check_limit(limit: int | str | None) -> int | None:
    """The limit as a number: an int or its text, not negative."""
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, (int, str)):
        raise TypeError("limit must be an int or a str")
    if int(limit) < 0:
        raise ValueError(f"limit must not be negative, got {limit}")
    return int(limit)


def collect_ids(df: DataFrame, column: str = "uid", lists: int = 1) -> DataFrame:
    """Collect ids into ``lists`` sorted lists, ``chunk, n, ids``; ids go to lists by their md5, an empty list has no row.

    One list is one row in one task: a collection that may be large needs more lists, or stays a table of ids.
    """
    if lists < 1:
        raise ValueError("at least one list")
    chunk = F.pmod(F.conv(F.substring(F.md5(F.col(column)), 1, 8), 16, 10).cast("bigint"), F.lit(lists))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(chunk.alias("chunk"))
        .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(column)).alias("ids"))
    )
