"""Bulk upsert of a table into one label of a stored graph.

A mapping lists (graph field, source column) pairs. A vertex mapping starts with ``__uid``; an edge mapping starts with
``__usid, __udid, __uslabels, __udlabels`` and may name the edge id as ``__uid``. Edge labels come from a column,
``[column]``, or are constant, ``['Label']``.

Contract: mapped columns overwrite, also with null; properties that are not mapped keep their stored value; a new key is
inserted. Of several source rows with one key, the greatest by ``order_by`` and then by all mapped columns wins (nulls are
least). Rows without uid or endpoint are rejected with a reason. Edges may be stored before their endpoints. A cell that does
not fit the type of its property leaves the stored value as it is (a new element has null there) and is counted in the report.

Names that begin with ``__`` are the load's own; a property cannot be declared with one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from propgraph.session import child_names, scratch_path
from propgraph.storage import BUCKET, StoredGraph, bucket_of

# Reserved fields of a load mapping.
UID = "__uid"
SOURCE_UID, TARGET_UID, SOURCE_LABELS, TARGET_LABELS = EDGE_FIELDS = ["__usid", "__udid", "__uslabels", "__udlabels"]

#: Why a row is rejected.
REASONS = {"vertex": ["no_uid"], "edge": ["no_src_uid", "no_dst_uid", "no_src_label", "no_dst_label"]}

Mapping = Sequence[tuple[str, str]]

REPORT_SCHEMA = "label string, outcome string, reason string, n bigint"


@dataclass(frozen=True)
class LoadResult:
    """The graph after a load, and the load's report: ``label, outcome, reason, n``."""

    graph: StoredGraph
    report: DataFrame


def _check_names(mapping: Mapping) -> None:
    names = [name.lower() for name, _ in mapping]
    twice = sorted({name for name, _ in mapping if names.count(name.lower()) > 1})
    if twice:
        raise ValueError(f"mapped more than once: {', '.join(twice)}")


def check_vertex_mapping(mapping: Mapping) -> None:
    if not mapping or mapping[0][0] != UID:
        raise ValueError(f"a vertex mapping must start with {UID}")
    _check_names(mapping)


def check_edge_mapping(mapping: Mapping) -> None:
    if len(mapping) < len(EDGE_FIELDS):
        raise ValueError(f"an edge mapping needs at least {len(EDGE_FIELDS)} entries")
    if [name for name, _ in mapping[: len(EDGE_FIELDS)]] != EDGE_FIELDS:
        raise ValueError(f"an edge mapping must start with {', '.join(EDGE_FIELDS)}")
    _check_names(mapping)


def endpoint_label(text: str) -> Column:
    """``['Label']`` is a constant, ``[column]`` names a column."""
    constant = re.fullmatch(r"\[\s*(['\"])(.+)\1\s*\]", text)
    if constant:
        return F.lit(constant.group(2))
    column = re.fullmatch(r"\[\s*(.+?)\s*\]", text)
    if not column:
        raise ValueError(f"an endpoint label is [column] or ['Label'], got {text}")
    return F.col(column.group(1)).cast("string")


def load_vertices(
    graph: StoredGraph, source: DataFrame, label: str, mapping: Mapping, order_by: Sequence[str] = ()
) -> LoadResult:
    """Upsert a table under one vertex label."""
    check_vertex_mapping(mapping)
    schema = graph.schema.vertex_type(label)
    keys = {"uid": F.col(mapping[0][1]).cast("string")}
    reason = F.when(F.col("uid").isNull(), "no_uid")
    return _upsert(graph, "vertex", label, source, schema, keys, mapping[1:], reason, order_by)


def load_edges(
    graph: StoredGraph, source: DataFrame, label: str, mapping: Mapping, order_by: Sequence[str] = ()
) -> LoadResult:
    """Upsert a table under one edge label. The report counts edges whose endpoint is not in the graph (yet)."""
    check_edge_mapping(mapping)
    schema = graph.schema.edge_type(label)
    properties = [(name, column) for name, column in mapping[len(EDGE_FIELDS) :] if name != UID]
    edge_ids = [F.coalesce(F.col(column).cast("string"), F.lit("")) for name, column in mapping if name == UID]
    keys = {
        "src_label": endpoint_label(mapping[2][1]),
        "src_uid": F.col(mapping[0][1]).cast("string"),
        "dst_label": endpoint_label(mapping[3][1]),
        "dst_uid": F.col(mapping[1][1]).cast("string"),
        "euid": edge_ids[0] if edge_ids else F.lit(""),
    }
    reason = (
        F.when(F.col("src_uid").isNull(), "no_src_uid")
        .when(F.col("dst_uid").isNull(), "no_dst_uid")
        .when(F.col("src_label").isNull(), "no_src_label")
        .when(F.col("dst_label").isNull(), "no_dst_label")
    )
    return _upsert(graph, "edge", label, source, schema, keys, properties, reason, order_by)


def mapped_rows(
    source: DataFrame,
    schema: StructType,
    keys: dict[str, Column],
    properties: Mapping,
    reason: Column,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The source in the shape of the label's table, with ``__order`` columns, a flag ``__bad_<property>`` for cells that do
    not fit, and the reject reason ``__reason``, which is a condition on the keys."""
    unknown = [name for name, _ in properties if name not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"not declared: {', '.join(unknown)}")
    values = []
    for name, column in properties:
        fitted = F.col(column).try_cast(schema[name].dataType)
        values += [fitted.alias(name), (F.col(column).isNotNull() & fitted.isNull()).alias(f"__bad_{name}")]
    order = [F.col(c).alias(f"__order{i}") for i, c in enumerate(order_by)]
    keyed = [c.alias(name) for name, c in keys.items()]
    return source.select(*keyed, *values, *order).withColumn("__reason", reason)


def latest_per_key(rows: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by the order columns and then by all values; adds ``__rows``, the rows it stands for, and
    for flags ``__bad_<property>`` the counts of set ones, ``__bads_<property>``.

    A maximum over structs combines on the map side, so a key with very many rows is down to one row per task before the
    shuffle; a window over the key would bring all of them to one task.
    """
    unordered = {f.name for f in rows.schema.fields if isinstance(f.dataType, (MapType, VariantType))}
    if not values and not order:
        best = F.max(F.struct(F.lit(0)))
    elif unordered.isdisjoint(values):
        best = F.max(F.struct(*(F.col(f"`{c}`") for c in (*order, *values))))
    else:  # maps and variants have no order of their own: rank them by their JSON text
        ranks = [F.to_json(F.struct(F.col(f"`{v}`"))) if v in unordered else F.col(f"`{v}`") for v in values]
        best = F.max_by(F.struct(*(F.col(f"`{v}`") for v in values)), F.struct(*order, *ranks))
    flags = [v for v in values if v.startswith("__bad_")]
    counts = [F.sum(F.col(f"`{v}`").cast("bigint")).alias(v.replace("__bad_", "__bads_", 1)) for v in flags]
    best = rows.groupBy(*keys).agg(best.alias("__best"), F.count(F.lit(1)).alias("__rows"), *counts)
    sums = [v.replace("__bad_", "__bads_", 1) for v in flags]
    return best.select(*keys, *(F.col(f"__best.`{v}`").alias(v) for v in values), "__rows", *(F.col(f"`{s}`") for s in sums))


def merge(stored: DataFrame, batch: DataFrame, keys: Sequence[str], mapped: Sequence[str]) -> DataFrame:
    """Full outer join of the stored label and a batch with unique keys. Adds ``__inserted`` and ``__updated`` flags and keeps
    the batch's own columns. Rows with a null key match nothing.

    The batch is partitioned by the key since it was made unique, so the join shuffles the stored side only, and adaptive
    execution sizes the written files.
    """
    old = stored.select(*keys, F.struct(*stored.columns).alias("__old"))
    extra = [c for c in batch.columns if c.startswith("__") and c != "__reason"]
    new = batch.select(*keys, *([F.col("__reason")] if "__reason" in batch.columns else []), F.struct(*(F.col(f"`{c}`") for c in (*mapped, *extra))).alias("__new"))
    joined = old.join(new, list(keys), "full_outer")

    def value(c: str) -> Column:
        before, after = F.col(f"__old.`{c}`"), F.col(f"__new.`{c}`")
        if c not in mapped:
            return before.alias(c)
        fits = F.col("__new").isNotNull()
        if f"__bad_{c}" in extra:
            fits = fits & ~F.col(f"__new.`__bad_{c}`")
        return F.when(fits, after).otherwise(before).alias(c)

    columns = [value(c) for c in stored.columns if c not in keys]
    return joined.select(
        *keys,
        *columns,
        F.col("__old").isNull().alias("__inserted"),
        (F.col("__old").isNotNull() & F.col("__new").isNotNull()).alias("__updated"),
        F.coalesce(F.col("__new.__rows"), F.lit(0)).alias("__rows"),
        *(F.col(f"__new.`{c}`").alias(c) for c in extra if c.startswith("__bads_")),
        *([F.col("__reason")] if "__reason" in batch.columns else []),
    )


def _first_load(batch: DataFrame, schema: StructType, keys: Sequence[str], mapped: Sequence[str]) -> DataFrame:
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in keys and f.name not in mapped]
    return batch.select(*batch.columns, *absent, F.lit(True).alias("__inserted"), F.lit(False).alias("__updated"))


def _upsert(
    graph: StoredGraph,
    kind: str,
    label: str,
    source: DataFrame,
    schema: StructType,
    keys: dict[str, Column],
    properties: Mapping,
    reason: Column,
    order_by: Sequence[str],
) -> LoadResult:
    spark = graph.spark
    key_names, mapped = list(keys), [name for name, _ in properties]
    rows = mapped_rows(source, schema, keys, properties, reason, order_by)
    order = [f"__order{i}" for i in range(len(order_by))]
    # Rejected rows come along, one per key and reason, so that the write counts them too; a reason depends on the key alone.
    flags = [f"__bad_{name}" for name in mapped]
    batch = latest_per_key(rows, [*key_names, "__reason"], [c for pair in zip(mapped, flags) for c in pair], order)
    bucket = bucket_of(key_names, graph.schema.shards)
    if graph.has_data(kind, label):
        # The batch is computed once; the buckets that none of its keys falls into keep their files.
        # Which these are is noted in the write: at most as many names as the graph has shards.
        path, seen = scratch_path(spark, "batch"), Observation()
        touched = F.collect_set(F.when(F.col("__reason").isNull(), bucket))
        batch.observe(seen, touched.alias("touched")).write.parquet(path)
        batch = spark.read.schema(batch.schema).parquet(path)
        merged = merge(graph.buckets(kind, label, seen.get["touched"] or []), batch, key_names, mapped)
    else:
        merged = _first_load(batch, schema, key_names, mapped)
    # Adaptive execution sizes the files of each bucket, and cuts large ones.
    merged = merged.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))

    # The counts ride along in the last stage of the write, which counts every partition exactly once.
    counts = Observation()
    good = F.col("__reason").isNull()
    observed = merged.observe(
        counts,
        F.count(F.when(good & F.col("__inserted"), 1)).alias("inserted"),
        F.count(F.when(good & F.col("__updated"), 1)).alias("updated"),
        F.sum(F.when(good & (F.col("__rows") > 0), F.col("__rows") - 1)).alias("superseded"),
        *(F.sum(F.when(F.col("__reason") == r, F.col("__rows"))).alias(f"reason {r}") for r in REASONS[kind]),
        *(F.sum(F.when(good, F.col(f"`__bads_{name}`"))).alias(f"cells {name}") for name in mapped),
    )
    version = graph.new_table_version()
    # Readers name the columns of the schema; ``__loaded`` serves the report alone.
    written = observed.where(good).select(*(F.col(f"`{c}`") for c in schema.fieldNames()), (F.col("__rows") > 0).alias("__loaded"), BUCKET)
    table = graph.table_path(kind, label, version)
    written.write.partitionBy(BUCKET).parquet(table)
    names = child_names(spark, table)
    loaded = graph.publish(kind, label, version, [n.removeprefix(f"{BUCKET}=") for n in names if n.startswith(f"{BUCKET}=")])

    n = counts.get
    report = [(label, outcome, None, n[outcome] or 0) for outcome in ("inserted", "updated", "superseded")]
    report += [(label, "rejected", r, n[f"reason {r}"]) for r in REASONS[kind] if n[f"reason {r}"]]
    report += [(label, "cell does not fit", name, n[f"cells {name}"]) for name in mapped if n[f"cells {name}"]]
    summary = spark.createDataFrame(report, REPORT_SCHEMA)
    if kind == "edge":
        edges = spark.read.schema(written.select(*key_names, "__loaded").schema).parquet(table)
        summary = summary.unionByName(missing_endpoints(loaded, label, edges.where("__loaded")))
    return LoadResult(loaded, summary)


def missing_endpoints(graph: StoredGraph, label: str, edges: DataFrame) -> DataFrame:
    """Edges whose start or end vertex is not in the graph. Both ends are counted in one pass and before the anti join, so hubs
    are single rows in it."""
    sides = ("src", "dst")
    ends = F.explode(
        F.array(*(F.struct(F.col(f"{s}_label").alias("label"), F.col(f"{s}_uid").alias("uid"), F.lit(s).alias("side")) for s in sides))
    )
    missing = (
        edges.select(ends.alias("end"))
        .groupBy("end.label", "end.uid")
        .agg(*(F.count(F.when(F.col("end.side") == s, 1)).alias(s) for s in sides))
        .join(graph.vertex_ids(), ["label", "uid"], "left_anti")
        .agg(*(F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sides))
    )
    rows = F.explode(F.array(*(F.struct(F.lit(f"no_{s}_vertex").alias("reason"), F.col(s).alias("n")) for s in sides)))
    return missing.select(rows.alias("r")).select(
        F.lit(label).alias("label"), F.lit("dangling").alias("outcome"), "r.reason", "r.n"
    )
