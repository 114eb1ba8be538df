"""A property graph as typed tables, one per label.

Vertex table of a label:  ``uid``, the properties, optionally ``tags``
Edge table of a label:    ``src_label, src_uid, dst_label, dst_uid, euid``, the properties, optionally ``tags``

A vertex is identified by (label, uid), an edge by (label, src_label, src_uid, dst_label, dst_uid, euid). The tables may
come from anywhere (``vertex_table`` and ``edge_table`` map plain columns) or from a stored graph (``propgraph.storage``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.functions.properties import pack_properties

ENDPOINT_COLUMNS = ["src_label", "src_uid", "dst_label", "dst_uid"]
EDGE_KEY_COLUMNS = [*ENDPOINT_COLUMNS, "euid"]
TAGS = "tags"


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def vertex_table(df: DataFrame, uid: Column | str, *properties: Column | str) -> DataFrame:
    """Select a vertex table of one label from any table."""
    return df.select(_text(uid).alias("uid"), *properties)


def edge_table(
    df: DataFrame,
    src_label: str,
    src_uid: Column | str,
    dst_label: str,
    dst_uid: Column | str,
    *properties: Column | str,
    euid: Column | str | None = None,
) -> DataFrame:
    """Select an edge table of one label from any table."""
    return df.select(
        F.lit(src_label).alias("src_label"),
        _text(src_uid).alias("src_uid"),
        F.lit(dst_label).alias("dst_label"),
        _text(dst_uid).alias("dst_uid"),
        (F.lit("") if euid is None else F.coalesce(_text(euid), F.lit(""))).alias("euid"),
        *properties,
    )


def vertex_id(label: Column, uid: Column) -> Column:
    """Text id of a vertex that is unique over all labels."""
    return F.concat(label, F.lit(":"), uid)


def identity_text(*key: str) -> Column:
    """The key columns as one text; every part is preceded by its length, so different keys have different texts."""
    return F.concat_ws(":", *(x for c in key for x in (F.length(c), F.col(c))))


def table_names(labels: Sequence[str]) -> dict[str, str]:
    """A name that a catalog takes for every label; labels that would share one get their place as an addition."""
    plain = {label: re.sub(r"[^A-Za-z0-9_]", "_", label) for label in labels}
    taken = [name.lower() for name in plain.values()]
    return {label: name if taken.count(name.lower()) == 1 else f"{name}_{i}" for i, (label, name) in enumerate(plain.items())}


class PropertyGraph:
    """Vertex and edge tables by label. Everything is lazy; no method runs a job."""

    #: Whether both endpoints of every edge are known to be vertices.
    whole = False

    def __init__(self, vertex_tables: Mapping[str, DataFrame], edge_tables: Mapping[str, DataFrame]):
        if not vertex_tables:
            raise ValueError("a graph needs at least one vertex label")
        self.vertex_tables = dict(vertex_tables)
        self.edge_tables = dict(edge_tables)

    def _labels(self, tables: Mapping[str, DataFrame], label: str | None) -> dict[str, DataFrame]:
        if label is None:
            return dict(tables)
        if label not in tables:
            raise ValueError(f"no label `{label}`; known: {sorted(tables)}")
        return {label: tables[label]}

    def vertex_rows(self, label: str, uids: Sequence[str] | None) -> DataFrame:
        """The table of a label, or a part of it that holds all vertices with these uids."""
        return self.vertex_tables[label]

    def edge_parts(self, label: str | None, side: str) -> list[DataFrame | None]:
        """Tables that together hold the edges of a label, laid out for joins at ``side`` (src or dst) where they can be;
        None stands for the label's whole table."""
        return [None]

    def tag_columns(self, kind: str, label: str) -> list[str]:
        """The tags column of a label's table, if it has one."""
        return [TAGS] if _has_tags((self.vertex_tables if kind == "vertex" else self.edge_tables)[label]) else []

    def vertex_properties(self, label: str) -> list[str]:
        return [c for c in self.vertex_tables[label].columns if c != "uid" and not (c == TAGS and _has_tags(self.vertex_tables[label]))]

    def edge_properties(self, label: str) -> list[str]:
        return [c for c in self.edge_tables[label].columns if c not in EDGE_KEY_COLUMNS and not (c == TAGS and _has_tags(self.edge_tables[label]))]

    def vertices(self, label: str | None = None) -> DataFrame:
        """Vertices of one label (or all) as elements: ``label, uid, tags, properties, rk``. The row key is the identity."""
        parts = []
        for name, table in self._labels(self.vertex_tables, label).items():
            packed = pack_properties({c: F.col(f"`{c}`") for c in self.vertex_properties(name)})
            parts.append(
                table.select(
                    F.lit(name).alias("label"),
                    "uid",
                    _tags(table).alias("tags"),
                    packed.alias("properties"),
                ).withColumn("rk", identity_text("label", "uid"))
            )
        return reduce(DataFrame.unionByName, parts)

    def edges(self, label: str | None = None) -> DataFrame:
        """Edges of one label (or all) as elements: ``label, euid, src, dst, tags, properties, rk``."""
        parts = []
        for name, table in self._labels(self.edge_tables, label).items():
            packed = pack_properties({c: F.col(f"`{c}`") for c in self.edge_properties(name)})
            parts.append(
                table.select(
                    F.lit(name).alias("label"),
                    "euid",
                    _stub("src").alias("src"),
                    _stub("dst").alias("dst"),
                    _tags(table).alias("tags"),
                    packed.alias("properties"),
                    *(F.col(c).alias(f"__{c}") for c in ENDPOINT_COLUMNS),
                )
                .withColumn("rk", identity_text("label", *(f"__{c}" for c in ENDPOINT_COLUMNS), "euid"))
                .drop(*(f"__{c}" for c in ENDPOINT_COLUMNS))
            )
        return reduce(DataFrame.unionByName, parts)

    def vertex_ids(self, label: str | None = None) -> DataFrame:
        """``label, uid`` of the vertices; reads no property."""
        parts = [
            table.select(F.lit(name).alias("label"), "uid")
            for name, table in self._labels(self.vertex_tables, label).items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def edge_ids(self, label: str | None = None) -> DataFrame:
        """``label`` and key columns of the edges; reads no property."""
        parts = [
            table.select(F.lit(name).alias("label"), *EDGE_KEY_COLUMNS)
            for name, table in self._labels(self.edge_tables, label).items()
        ]
        return reduce(DataFrame.unionByName, parts)


def _has_tags(table: DataFrame) -> bool:
    """Whether the column ``tags`` holds tags; of another type it is a property like any other."""
    return dict(table.dtypes).get(TAGS) == "array<string>"


def _tags(table: DataFrame) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(F.col(TAGS), empty) if _has_tags(table) else empty


def _stub(side: str) -> Column:
    """An edge's endpoint: identity only, no properties."""
    return F.struct(
        F.col(f"{side}_label").alias("label"),
        F.col(f"{side}_uid").alias("uid"),
        identity_text(f"{side}_label", f"{side}_uid").alias("rk"),
    )
