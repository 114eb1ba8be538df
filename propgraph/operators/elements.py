"""Operations on tables of elements: projection, properties, distinct, paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.functions.properties import canonical_text, get_property, has_property, set_property
from propgraph.operators.skew import ROWS_PER_TASK, spread_join


def project_vertices(vertices: DataFrame) -> DataFrame:
    """``label, uid, tags, rk`` of vertex elements."""
    return vertices.select("label", "uid", "tags", "rk")


def project_edges(edges: DataFrame) -> DataFrame:
    """``label, euid, tags, rk`` and both endpoints' identity of edge elements."""
    return edges.select(
        "label",
        "euid",
        F.col("src.label").alias("src_label"),
        F.col("src.uid").alias("src_uid"),
        F.col("dst.label").alias("dst_label"),
        F.col("dst.uid").alias("dst_uid"),
        "tags",
        "rk",
    )


def with_property(df: DataFrame, name: str, data_type: str = "string", required: bool = False) -> DataFrame:
    """Add one property as a typed column."""
    return df.withColumn(name, get_property(F.col("properties"), name, data_type, required))


def where_has(df: DataFrame, name: str) -> DataFrame:
    """Elements that have the property, whatever its value."""
    return df.where(has_property(F.col("properties"), name))


def update_property(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set one property on every element."""
    return df.withColumn("properties", set_property(F.col("properties"), name, value))


def update_tags(df: DataFrame, tags: Column) -> DataFrame:
    """Replace the tags of every element."""
    return df.withColumn("tags", tags.cast("array<string>"))


def distinct_elements(elements: DataFrame, kind: str = "kind") -> DataFrame:
    """One row per element. Two elements of a kind are equal if their row keys are; elements without row key are equal if
    their properties are. ``elements`` has ``kind, rk, properties``.

    The duplicate check combines on the map side, so a key that repeats very often is one row per task in the shuffle.
    """
    key = F.nullif(F.col("rk"), F.lit(""))
    return (
        elements.withColumn("__rk", key)
        .withColumn("__properties", F.when(key.isNull(), canonical_text(F.col("properties"))))
        .dropDuplicates([kind, "__rk", "__properties"])
        .drop("__rk", "__properties")
    )


def path_key(path: Column) -> Column:
    """Row keys of a path's elements in order, and of an element without row key its properties, by which such elements are
    equal or not; equal for equal paths only. One text, every part preceded by its length, which moves and sorts as such."""

    def part(text: Column) -> Column:
        return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))

    def key(e: Column) -> Column:
        rk = F.coalesce(F.nullif(e["vertex"]["rk"], F.lit("")), F.nullif(e["edge"]["rk"], F.lit("")))
        properties = canonical_text(F.coalesce(e["vertex"]["properties"], e["edge"]["properties"]))
        return F.concat(part(e["kind"]), part(rk), F.when(rk.isNull(), part(properties)).otherwise(F.lit("")))

    return F.array_join(F.transform(path, key), "")


def distinct_paths(paths: DataFrame, path: str = "path", select: Sequence[Column] | None = None) -> DataFrame:
    """One row per path: same length and pairwise equal elements.

    With ``select``, these columns of each kept row come out instead. They are computed before the duplicate check, which
    moves and sorts them and the paths' keys, not the whole elements.
    """
    kept = paths.columns if select is None else select
    return paths.select(*kept, path_key(F.col(path)).alias("__key")).dropDuplicates(["__key"]).drop("__key")


def path_length(path: Column) -> Column:
    """Number of elements, vertices and edges."""
    return F.size(path)


def path_lengths(elements: DataFrame, path_id: Sequence[str]) -> DataFrame:
    """Path length from the long form."""
    return elements.groupBy(*path_id).agg(F.count(F.lit(1)).alias("length"))


def keys_to_uids(
    result: DataFrame, key: str, vertices: DataFrame, uid: str = "uid", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Translate a column of vertex row keys to user ids; ``vertices`` has ``rk, uid``. A key without vertex gives null.

    One vertex may be named by very many result rows, so its rows are spread.
    """
    lookup = vertices.select(F.col("rk").alias(key), F.col("uid").alias(uid))
    return spread_join(result, lookup, [key], "left", rows_per_task)


def key_report(df: DataFrame, shard: Column, label: Column) -> DataFrame:
    """Keys per shard and label index."""
    return df.groupBy(shard.alias("shard_id"), label.alias("label_index")).agg(F.count(F.lit(1)).alias("n"))
